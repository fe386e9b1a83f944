"""Adding a column that a task computes batch by batch, next to all others."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from commitlens.llm.tokens import slices


def unused_name(df: DataFrame, base: str) -> str:
    """`base`, with underscores behind it until no column of `df` is called so."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


@contextmanager
def arrow_bytes(spark: SparkSession, limit: int) -> Iterator[None]:
    """Bounds what one Arrow batch to a worker holds, for jobs that run inside; a row is never cut."""
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, str(limit))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(setting)
        else:
            spark.conf.set(setting, before)


def with_computed(
    df: DataFrame,
    name: str,
    kind: T.DataType,
    source: Column,
    compute: Callable[[list], list],
    keep: list[str] | None = None,
) -> DataFrame:
    """`df` and column `name`: `compute` maps a list of `source` values to as many results.

    With `keep`, only those columns of `df` remain. Rows keep their order and
    nothing is shuffled.
    """
    kept = df.columns if keep is None else keep
    work = unused_name(df, "__source")
    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField(name, kind)])
    arrow = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = pa.array(compute(part.column(part.num_columns - 1).to_pylist()), arrow)
                yield pa.record_batch([*part.columns[:-1], found], [*kept, name])

    quoted = [f"`{c.replace('`', '``')}`" for c in kept]
    return df.select(*quoted, source.alias(work)).mapInArrow(run, schema)
