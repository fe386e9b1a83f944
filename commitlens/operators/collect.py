"""Ordered collect: a group's values in a stated order, as one array, as pieces, or as rows."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from commitlens.operators.skew import CHUNK, MAX_GROUP_ROWS, split_hot_groups
from commitlens.scratch import stored


def _items(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    return df.select(*dict.fromkeys([*keys, *order]), F.col(value).alias("__value"))


def collect_ordered(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """`(keys, values)`: one row per key, its non-null values in order.

    A key of nulls only has an empty array. A group's values must fit one row;
    where they may not, take `collect_pieces` or `ordered_values`.
    """
    item = F.when(F.col("__value").isNotNull(), F.struct(*order, "__value"))
    values = F.transform(F.sort_array(F.collect_list(item)), lambda x: x["__value"])
    return _items(df, keys, order, value).groupBy(*keys).agg(values.alias("values"))


def ordered_values(
    df: DataFrame, keys: list[str], order: list[str], value: str, max_group_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """`(keys, position, value)`: a row per non-null value, positions from 1 in order.

    For groups of any size: hot ones are numbered chunk by chunk. `max_group_rows`
    decides how, never what comes out. `order` must order a key's rows totally.
    """
    items = _items(df, keys, order, value).filter(F.col("__value").isNotNull())

    def numbered(rows: DataFrame, along: list[str]) -> DataFrame:
        return rows.withColumn("position", F.row_number().over(Window.partitionBy(*along).orderBy(*order)).cast("long"))

    wanted = [*keys, "position", F.col("__value").alias("value")]
    ordinary, hot = split_hot_groups(items, keys, order, max_group_rows)
    result = None if ordinary is None else numbered(ordinary, keys).select(*wanted)
    if hot is None:
        return result
    rows = stored(numbered(hot.rows, [*keys, CHUNK]))
    before = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy(*keys, CHUNK).agg(F.max("position").alias("n"))
    sizes = sizes.select(*keys, CHUNK, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"))
    carried = hot.with_chunk_values(rows, stored(sizes), keys)
    found = carried.withColumn("position", F.col("position") + F.col("__before")).select(*wanted)
    return found if result is None else result.unionByName(found)


def collect_pieces(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    value: str,
    piece_length: int,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """`(keys, part, values)`: every key's values in arrays of `piece_length`, the last may be shorter.

    Parts count from 0 within a key. A key of nulls only has no part.
    """
    part = F.expr(f"(position - 1) div {int(piece_length)}").alias("part")
    pieces = ordered_values(df, keys, order, value, max_group_rows).select(*keys, part, "position", "value")
    items = F.sort_array(F.collect_list(F.struct("position", "value")))
    return pieces.groupBy(*keys, "part").agg(F.transform(items, lambda x: x["value"]).alias("values"))
