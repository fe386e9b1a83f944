"""Blocks: runs of rows opened by a marker row, per key and in a stated order.

A line of text belongs to the last header above it, an event to the last
sign-up before it. Keys of ordinary size take one window. Hot keys are worked
on chunk by chunk (see `skew`): rows are numbered within their chunk, once, and
what lies outside a chunk is added from a table with one row per chunk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commitlens.functions.names import quoted
from commitlens.operators.skew import CHUNK, MAX_GROUP_ROWS, split_hot_groups
from commitlens.scratch import stored

# Working columns. The input's own columns are numbered while the work is done, so any names will do.
MARK, ID, START = "__mark", "__id", "__start"
AT, SEQ, OPENED, OPEN_ID = "__at", "__seq", "__opened", "__open_id"


def _along_chunks(keys: list[str]):
    return Window.partitionBy(*keys).orderBy(CHUNK)


def _numbered(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Per row: its number, markers so far, and number and id of the last marker's row."""
    so_far = (
        Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        rows.withColumn(AT, F.count(F.lit(1)).over(so_far))
        .withColumn(SEQ, F.sum(MARK).over(so_far))
        .withColumn(OPENED, F.last(F.when(F.col(MARK) == 1, F.col(AT)), ignorenulls=True).over(so_far))
        .withColumn(OPEN_ID, F.last(ID, ignorenulls=True).over(so_far))
    )


def _carries(numbered: DataFrame, keys: list[str]) -> DataFrame:
    """Per chunk, of its key's rows before it: markers, rows since the last one, its id."""
    before = _along_chunks(keys).rowsBetween(Window.unboundedPreceding, -1)
    chunks = numbered.groupBy(*keys, CHUNK).agg(
        F.max(AT).alias("n"),
        F.max(SEQ).alias("markers"),
        F.max(OPENED).alias("last_at"),
        F.max_by(OPEN_ID, AT).alias("last_id"),
    )
    rows_before = F.coalesce(F.sum("n").over(before), F.lit(0))
    return (
        chunks.withColumn("rows_before", rows_before)
        .withColumn("opened_at", F.col("rows_before") + F.col("last_at"))
        .select(
            *keys,
            CHUNK,
            F.coalesce(F.sum("markers").over(before), F.lit(0)).alias("__markers_before"),
            F.last("last_id", ignorenulls=True).over(before).alias("__id_before"),
            (
                F.col("rows_before") - F.coalesce(F.last("opened_at", ignorenulls=True).over(before) - 1, F.lit(0))
            ).alias("__rows_before"),
        )
    )


def _named(numbered: DataFrame, columns: dict[str, str], seq: Column, open_id: Column, in_block: Column) -> DataFrame:
    return numbered.select(
        *(F.col(inner).alias(name) for name, inner in columns.items()),
        open_id[0].alias("block_id"),
        seq.alias("block_seq"),
        in_block.alias("row_in_block"),
    )


def _refuse(names: list[str], added: list[str]) -> None:
    """Columns that are added must not be there already."""
    taken = {n.lower() for n in names} & {a.lower() for a in added}
    if taken:
        raise ValueError(f"the table already has {sorted(taken)}")


def assign_blocks(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    is_marker: Column,
    id_column: str,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add `block_id`, `block_seq` and `row_in_block` to every row.

    A block starts at a marker row and is named by that row's `id_column`. Blocks
    count from 1 within a key; rows before its first marker have a null id and
    sequence 0. `order` must order the rows of a key totally. Without `keys` the
    whole table is one key, of any size. Other columns may be called anything but
    like those that are added.
    """
    _refuse(df.columns, ["block_id", "block_seq", "row_in_block"])
    columns = {c: f"c{i}" for i, c in enumerate(df.columns)}
    marker = F.coalesce(is_marker, F.lit(False))
    rows = df.select(
        *(F.col(quoted(c)).alias(inner) for c, inner in columns.items()),
        marker.cast("long").alias(MARK),
        # In an array, so that a marker with a null id still ends the block before.
        F.when(marker, F.array(F.col(quoted(id_column)))).alias(ID),
    )
    keys, order = [columns[k] for k in keys], [columns[o] for o in order]
    ordinary, hot = split_hot_groups(rows, keys, order, max_group_rows)
    at, seq, opened, open_id = (F.col(c) for c in (AT, SEQ, OPENED, OPEN_ID))
    result = None
    if ordinary is not None:
        in_block = at - F.coalesce(opened - 1, F.lit(0))
        result = _named(_numbered(ordinary, keys, order), columns, seq, open_id, in_block)
    if hot is None:
        return result
    # Stored, because a lost task might otherwise draw other chunks.
    numbered = stored(_numbered(hot.rows, [*keys, CHUNK], order))
    carried = hot.with_chunk_values(numbered, stored(_carries(numbered, keys)), keys)
    in_block = F.when(opened.isNull(), F.col("__rows_before") + at).otherwise(at - opened + 1)
    found = _named(
        carried,
        columns,
        seq + F.col("__markers_before"),
        F.coalesce(open_id, F.col("__id_before")),
        in_block,
    )
    return found if result is None else result.unionByName(found)


def _bounds(starts: DataFrame, keys: list[str]) -> DataFrame:
    along = Window.partitionBy(*keys).orderBy(START)
    return starts.withColumn("next", F.lead(START).over(along)).withColumn("block_seq", F.row_number().over(along).cast("long"))


def block_bounds(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    is_marker: Column,
    id_column: str,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """One row per block: keys, `block_id`, `block_seq`, `start_<order>`, `next_<order>`.

    `next_…` is where the key's next block starts, null for its last block. Without
    `keys` the whole table is one key.
    """
    _refuse(keys, ["block_id", "block_seq", *(f"{side}_{c}" for side in ("start", "next") for c in order)])
    names = {f"c{i}": k for i, k in enumerate(keys)}
    keys = list(names)
    starts = df.filter(is_marker).select(
        *(F.col(quoted(name)).alias(inner) for inner, name in names.items()),
        F.col(quoted(id_column)).alias("block_id"),
        F.struct(*(F.col(quoted(c)) for c in order)).alias(START),
    )

    def wanted(seq: Column, following: Column) -> list:
        return [
            *(F.col(inner).alias(name) for inner, name in names.items()),
            "block_id",
            seq.alias("block_seq"),
            *(F.col(START)[c].alias(f"start_{c}") for c in order),
            *(following[c].alias(f"next_{c}") for c in order),
        ]

    ordinary, hot = split_hot_groups(starts, keys, [START], max_group_rows)
    result = None
    if ordinary is not None:
        result = _bounds(ordinary, keys).select(*wanted(F.col("block_seq"), F.col("next")))
    if hot is None:
        return result
    numbered = stored(_bounds(hot.rows, [*keys, CHUNK]))
    along = _along_chunks(keys)
    chunks = numbered.groupBy(*keys, CHUNK).agg(F.max("block_seq").alias("n"), F.min(START).alias("first"))
    outside = chunks.select(
        *keys,
        CHUNK,
        F.coalesce(F.sum("n").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"),
        F.lead("first").over(along).alias("__after"),
    )
    carried = hot.with_chunk_values(numbered, stored(outside), keys)
    # The lead is missing on a chunk's last row only.
    found = carried.select(
        *wanted(F.col("block_seq") + F.col("__before"), F.coalesce(F.col("next"), F.col("__after")))
    )
    return found if result is None else result.unionByName(found)
