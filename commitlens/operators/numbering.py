"""Numbering the rows of a whole table in a stated order, without a key and without one large task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commitlens.functions.names import quoted, unused
from commitlens.operators.skew import MAX_BROADCAST_GROUPS
from commitlens.scratch import stored

# Rows of one sorted piece.
PIECE_ROWS = 1_000_000
# A row's place in its piece lies in the low bits of `monotonically_increasing_id`, the piece above.
_PLACE_BITS = 33


def number_rows(
    df: DataFrame, order: list[str | Column], name: str = "row_number", first: int = 0, piece_rows: int = PIECE_ROWS
) -> DataFrame:
    """`df` and column `name`: the row's number in `order`, from `first` on, without gaps.

    The table is range-partitioned into pieces of about `piece_rows` rows, which are
    sorted, numbered and stored once; a piece's first number is the sum of the sizes
    before it. So a number stays what it is when an executor is lost. `order` takes
    names or columns such as `F.desc("x")`; rows that tie are numbered in the order
    they are read in, and ties of any size are split like other rows. `piece_rows`
    decides how the work is done, never what comes out.
    """
    if name.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"the table already has {name}")
    tie, place, piece, before = (unused(f"__{n}", df) for n in ("tie", "place", "piece", "before"))
    along = [F.col(quoted(o)) if isinstance(o, str) else o for o in order] + [F.col(tie)]
    rows = df.withColumn(tie, F.monotonically_increasing_id())
    pieces = max(1, -(-df.count() // piece_rows))
    dealt = rows.repartitionByRange(pieces, *along).sortWithinPartitions(*along).drop(tie)
    held = stored(dealt.withColumn(place, F.monotonically_increasing_id()))
    own = F.shiftright(F.col(place), _PLACE_BITS)
    sizes = held.groupBy(own.alias(piece)).agg(F.count(F.lit(1)).alias("n"))
    # One row per piece.
    so_far = Window.orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(piece, F.coalesce(F.sum("n").over(so_far), F.lit(0)).alias(before))
    starts = F.broadcast(starts) if pieces <= MAX_BROADCAST_GROUPS else starts
    inside = F.col(place) - F.shiftleft(F.col(piece), _PLACE_BITS)
    return (
        held.withColumn(piece, own)
        .join(starts, piece)
        .select(*(quoted(c) for c in df.columns), (inside + F.col(before) + F.lit(first)).alias(name))
    )
