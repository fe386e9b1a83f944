"""Splitting hot groups, so that no task has to hold or sort one of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commitlens.scratch import stored

# Largest group left to one task.
MAX_GROUP_ROWS = 10_000_000
# Most hot groups, and bytes of their keys, that are broadcast; beyond, joins shuffle.
MAX_BROADCAST_GROUPS = 200_000
MAX_BROADCAST_BYTES = 32 << 20
CHUNK = "__chunk"


def same_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Equality of all keys, null equal to null."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(right[key])
    return condition


class HotGroups:
    """Rows of groups above a bound, dealt to chunks along the order.

    `rows` has the chunk's number as `CHUNK`: it grows along a group, and a chunk
    is of bounded size. `small` says whether tables with a row per group and chunk
    may be broadcast.
    """

    def __init__(self, rows: DataFrame, small: bool):
        self.rows, self.small = rows, small

    def with_chunk_values(self, numbered: DataFrame, values: DataFrame, keys: list[str]) -> DataFrame:
        """`numbered` and the columns of `values`, which has one row per group and chunk."""
        on = same_keys(numbered, values, [*keys, CHUNK])
        extra = [values[c] for c in values.columns if c not in (*keys, CHUNK)]
        joined = numbered.join(F.broadcast(values) if self.small else values, on)
        return joined.select(*(numbered[c] for c in numbered.columns), *extra)


def split_hot_groups(
    df: DataFrame, keys: list[str], order: list[str], max_group_rows: int = MAX_GROUP_ROWS
) -> tuple[DataFrame | None, HotGroups | None]:
    """Part `df` into the rows of ordinary groups and those of hot ones; either may be missing.

    A group above `max_group_rows` is hot. Finding out takes one counting pass over
    the keys; hot rows are stored by a second pass and dealt out from there.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    is_hot = F.col("n") > max_group_rows
    width = F.octet_length(F.concat_ws("", *(F.col(k).cast("string") for k in keys))) + 16 * len(keys)
    groups, hot_rows, key_bytes, rest = counts.agg(
        F.count_if(is_hot),
        F.sum(F.when(is_hot, F.col("n"))),
        F.sum(F.when(is_hot, width)),
        F.count_if(~is_hot),
    ).first()
    if not groups:
        return df, None
    # Chunks of about the bound, as even as a sample of the order makes them.
    chunks = -(-hot_rows // max_group_rows)
    # A chunk holds the end of one group and the start of another at least, or whole groups.
    small = max(groups, chunks) <= MAX_BROADCAST_GROUPS and key_bytes <= MAX_BROADCAST_BYTES
    hot, ordinary = df, None
    # Without keys all rows are one group.
    if rest and keys:
        hot_keys = stored(counts.filter(is_hot).select(*keys))
        hot_keys = F.broadcast(hot_keys) if small else hot_keys
        hot = df.join(hot_keys, same_keys(df, hot_keys, keys), "left_semi")
        ordinary = df.join(hot_keys, same_keys(df, hot_keys, keys), "left_anti")
    hot = stored(hot)
    dealt = hot.repartitionByRange(chunks, *keys, *order).withColumn(CHUNK, F.spark_partition_id())
    return ordinary, HotGroups(dealt, small)
