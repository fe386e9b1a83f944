"""Interval join: points with the intervals that hold them, which may overlap at will.

Every interval is cut at the edges of bins of one width and goes to each bin that
it touches; a point goes to its own bin. Where they meet, the bounds are compared.
So the join is an equi-join on bins, whatever the intervals look like.

One width does not suit short and long intervals alike, so there are several
levels of bins. A point goes to one bin of every level, which costs a row each; an
interval goes to the level that its length belongs to. Which widths there are is
worked out from the numbers of points and of intervals of each length, as the
choice with the least rows and comparisons.

A bin with many points or many intervals is split: its points are dealt to rows
and its intervals to columns of a grid, each goes to all cells of its own row or
column, and so every pair meets in one cell.

Where only counts and extremes of an interval's points are asked for, no pair is
made. Points and ends of intervals are numbered in one order, so an interval is a
range of numbers; a tree with 64 children a node holds what its points come to, and
a range is a few slices of nodes. That work grows with the rows, not with the pairs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commitlens.functions.names import quoted, unused
from commitlens.operators.numbering import number_rows
from commitlens.scratch import stored

# Most rows of one side of a bin that go to one task.
MAX_BIN_ROWS = 1_000_000
# Positions are whole numbers of at most this many bits.
_BITS = 63
# A node of the tree over numbered points has 64 children, a bit each of a long.
_FAN_BITS, _FAN = 6, 64
# Comparisons that one row more is worth.
_ROW = 64
_EXTREMES = {"min": (F.min, F.array_min), "max": (F.max, F.array_max)}


def _position(df: DataFrame, name: str) -> Column:
    """A point on the line as a long, in order of the column's values."""
    kind = df.schema[name].dataType
    column = F.col(quoted(name))
    if isinstance(kind, T.IntegralType):
        return column.cast("long")
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("long")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(kind, T.TimestampNTZType):
        # What the clock shows, in no time zone.
        minutes = (F.unix_date(column.cast("date")).cast("long") * 24 + F.hour(column)) * 60 + F.minute(column)
        return minutes * 60_000_000 + (F.extract(F.lit("SECOND"), column) * 1_000_000).cast("long")
    raise TypeError(f"{name}: bounds must be whole numbers, dates or timestamps, not {kind.simpleString()}")


def choose_levels(lengths: dict[int, int], points: int, spread: int, met: float | None = None) -> dict[int, int]:
    """For each length class (2^c <= length < 2^(c+1)) the level, that is the exponent of its bins' width.

    `lengths` counts intervals by class; `spread` is how far apart the outermost
    points are; `met` is how many points share an interval's keys, on average, all
    if it is None. An interval costs a row per bin that it touches and a comparison
    per point that lies in them but not in it, a level costs a row per point. A row
    is shuffled and so costs as much as `_ROW` comparisons.
    """
    classes = sorted(lengths)
    density = (points if met is None else met) / max(1, spread) / _ROW

    def cost(c: int, width: int) -> float:
        # Length 1.5 * 2^c on average; the first and the last bin stick out by one width together.
        return lengths[c] * (1.5 * 2.0 ** (c - width) + 1 + density * 2.0**width)

    # best[i]: least cost of the first i classes, how they end.
    best: list[tuple[float, int, int]] = [(0.0, 0, 0)]
    for i in range(1, len(classes) + 1):
        options = []
        for j in range(i):
            group = classes[j:i]
            for width in range(max(0, group[0] - 6), min(_BITS - 1, group[-1] + 1) + 1):
                options.append((best[j][0] + points + sum(cost(c, width) for c in group), j, width))
        best.append(min(options))
    out: dict[int, int] = {}
    i = len(classes)
    while i:
        _, j, width = best[i]
        out.update(dict.fromkeys(classes[j:i], width))
        i = j
    return out


@dataclass
class _Names:
    """Working columns, called like no column of either table."""

    at: str
    low: str
    high: str
    level: str
    bin: str
    row: str
    column: str
    deal: str

    @classmethod
    def of(cls, *tables: DataFrame) -> _Names:
        return cls(*(unused(f"__{name}", *tables) for name in cls.__dataclass_fields__))


def _class_of(length: Column) -> Column:
    """Exponent of the largest power of two that the length holds."""
    return F.length(F.bin(length)) - 1


def _of_shared_keys(points: DataFrame, intervals: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame, float]:
    """Rows of both sides whose keys the other side has too, and how many points an interval's keys have on average."""

    def counted(side: DataFrame, name: str) -> DataFrame:
        return side.groupBy(*map(quoted, keys)).agg(F.count(F.lit(1)).alias(name))

    both = [unused(f"__{name}", points, intervals) for name in ("points", "intervals")]
    shared = stored(counted(points, both[0]).join(counted(intervals, both[1]), keys))
    a, b = (F.col(c).cast("double") for c in both)
    met = shared.agg(F.sum(a * b) / F.sum(b)).first()[0] or 0.0
    named = shared.select(*map(quoted, keys))
    return points.join(named, keys, "left_semi"), intervals.join(named, keys, "left_semi"), met


def _split(points: DataFrame, ranges: DataFrame, on: list[str], n: _Names, max_rows: int) -> tuple[DataFrame, DataFrame]:
    """Grid rows and columns for both sides of every bin; one each where a bin is small."""

    def counted(side: DataFrame, name: str) -> DataFrame:
        if keys := on[:-2]:
            # Only a key with so many rows can have such a bin.
            hot = side.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > max_rows)
            side = side.join(F.broadcast(stored(hot.drop("__n"))), keys, "left_semi")
        cells = side.groupBy(*on).agg(F.count(F.lit(1)).alias("__n"))
        return cells.filter(F.col("__n") > max_rows).select(
            *on, F.ceil(F.col("__n") / max_rows).cast("int").alias(name)
        )

    # A row per bin above the bound, so at most one per so many rows.
    sizes = stored(counted(points, n.row).join(counted(ranges, n.column), on, "full"))
    if sizes.isEmpty():
        one = F.lit(0)
        return points.withColumns({n.row: one, n.column: one}), ranges.withColumns({n.row: one, n.column: one})
    one = F.lit(1)

    def dealt(side: DataFrame, own: str, other: str) -> DataFrame:
        # Numbered where the rows are read, so that a task that runs again deals alike.
        numbered = side.withColumn(n.deal, F.monotonically_increasing_id())
        known = numbered.join(sizes, on, "left").withColumns(
            {own: F.coalesce(F.col(own), one), other: F.coalesce(F.col(other), one)}
        )
        place = F.pmod(F.xxhash64(n.deal), F.col(own)).cast("int")
        return known.withColumn(own, place).withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other) - 1)))

    return dealt(points, n.row, n.column), dealt(ranges, n.column, n.row)


def _shifted(number: Column, levels: int) -> Column:
    """The node, so many levels up, that a number lies in."""
    return F.shiftright(number, _FAN_BITS * levels)


def _below(slot: Column) -> Column:
    """Bits of the slots before one; 64 is behind the last."""
    all_ = F.lit(-1).cast("long")
    return F.when(slot >= _FAN, all_).otherwise(F.bitwise_not(F.call_function("shiftleft", all_, slot)))


def _tree(items: DataFrame, extremes: dict[str, str], depth: int) -> DataFrame:
    """`(level, node, mask, n, <extremes>)` over `(at, n, <extremes>)`: arrays over the children that have points.

    `mask` has a bit for each of those. A node is an item of the level above.
    """
    levels = []
    for level in range(depth):
        child = F.struct("at", "n", *extremes)
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("at") % _FAN).cast("int"))
        nodes = items.groupBy(_shifted(F.col("at"), 1).alias("node")).agg(
            F.bit_or(bit).alias("mask"), F.array_sort(F.collect_list(child)).alias("children")
        )
        held = stored(nodes.select("node", "mask", *(F.col("children")[c].alias(c) for c in ("n", *extremes))))
        levels.append(held.withColumn("level", F.lit(level)))
        items = held.select(
            F.col("node").alias("at"),
            F.aggregate("n", F.lit(0).cast("long"), lambda a, b: a + b).alias("n"),
            *(_EXTREMES[kind][1](c).alias(c) for c, kind in extremes.items()),
        )
    out = levels[0]
    for nodes in levels[1:]:
        out = out.unionByName(nodes)
    return out


def _slices(first: Column, end: Column, depth: int) -> Column:
    """Slices `(level, node, start, stop)` of nodes that make up the numbers from `first` to before `end`."""
    out = []

    def cut(level: int, a: Column, b: Column, when: Column) -> None:
        node = _shifted(a, 1)
        ends = ((x - node * _FAN).cast("int") for x in (a, b))
        parts = zip(("level", "node", "start", "stop"), (F.lit(level), node, *ends))
        out.append(F.when(when & (a < b), F.struct(*(c.alias(name) for name, c in parts))))

    for level in range(depth):
        # Whole items of this level in the range, and whole nodes of them.
        a, b = _shifted(first + (_FAN**level - 1), level), _shifted(end, level)
        above, under = _shifted(a + (_FAN - 1), 1), _shifted(b, 1)
        cut(level, a, b, above > under)
        cut(level, a, above * _FAN, above <= under)
        cut(level, under * _FAN, b, above <= under)
    return F.array_compact(F.array(*out))


def _summed(
    points: DataFrame, intervals: DataFrame, point: str, low: str, high: str, keys: list[str], summary: dict[str, tuple[str, str | None]]
) -> DataFrame:
    """Every interval that holds a point, once, with the summary of its points."""
    keys_as = [f"k{i}" for i in range(len(keys))]
    others = [c for c in intervals.columns if c.lower() not in {k.lower() for k in keys}]
    own = {f"c{i}": c for i, c in enumerate([*keys, *others])}
    extremes = {f"s{i}": kind for i, (kind, _) in enumerate(summary.values()) if kind != "count"}
    values = {f"s{i}": c for i, (kind, c) in enumerate(summary.values()) if kind != "count"}

    def keyed(side: DataFrame) -> DataFrame:
        for key in keys:
            side = side.filter(F.col(quoted(key)).isNotNull())
        return side

    marks = keyed(points).select(
        *(F.col(quoted(k)).alias(a) for k, a in zip(keys, keys_as)),
        _position(points, point).alias("at"),
        F.lit(1).alias("kind"),
        *(F.col(quoted(c)).alias(a) for a, c in values.items()),
    ).filter("at IS NOT NULL")
    # A null bound lies before or behind every point.
    bounds = keyed(intervals).select(
        *(F.col(quoted(k)).alias(a) for k, a in zip(keys, keys_as)),
        *(F.col(quoted(c)).alias(a) for a, c in own.items()),
        F.coalesce(_position(intervals, low), F.lit(-(2**_BITS))).alias("low"),
        F.coalesce(_position(intervals, high), F.lit(2**_BITS - 1)).alias("high"),
        F.col(quoted(high)).isNull().alias("open"),
        F.monotonically_increasing_id().alias("id"),
    ).filter("low < high OR open")
    # An end stands before the points at its place, but an open one behind all.
    ends = F.array(
        F.struct(F.col("low").alias("at"), F.lit(0).alias("kind"), F.lit(True).alias("is_low")),
        F.struct(F.col("high").alias("at"), F.when(F.col("open"), 2).otherwise(0).alias("kind"), F.lit(False).alias("is_low")),
    )
    edges = bounds.select("*", F.inline(ends)).drop("low", "high", "open")
    order = [*keys_as, "at", "kind"]
    ranked = number_rows(marks.unionByName(edges, allowMissingColumns=True), order, "number")
    last = ranked.agg(F.max("number")).first()[0] or 0
    depth = 1
    while _FAN**depth <= last:
        depth += 1
    items = ranked.filter("kind = 1").select(F.col("number").alias("at"), F.lit(1).cast("long").alias("n"), *extremes)
    tree = _tree(items, extremes, depth)
    # What an interval brings along stands with its low end.
    brought = [F.any_value(F.when(F.col("is_low"), F.col(a)), F.lit(True)).alias(a) for a in own]
    spans = ranked.filter("kind <> 1").groupBy("id").agg(
        F.min(F.when(F.col("is_low"), F.col("number"))).alias("first"),
        F.min(F.when(~F.col("is_low"), F.col("number"))).alias("end"),
        *brought,
    )
    cut = spans.select("id", *own, F.inline(_slices(F.col("first"), F.col("end"), depth)))
    before, upto = _below(F.col("start")), _below(F.col("stop"))
    skipped = F.bit_count(F.col("mask").bitwiseAND(before))
    within = F.bit_count(F.col("mask").bitwiseAND(upto)) - skipped

    def part(name: str) -> Column:
        return F.slice(name, skipped + 1, within)

    met = cut.join(tree, ["level", "node"]).filter(within > 0).select(
        "id",
        *own,
        F.aggregate(part("n"), F.lit(0).cast("long"), lambda a, b: a + b).alias("n"),
        *(_EXTREMES[kind][1](part(a)).alias(a) for a, kind in extremes.items()),
    )
    whole = met.groupBy("id").agg(
        *(F.any_value(a).alias(a) for a in own),
        F.sum("n").alias("n"),
        *(_EXTREMES[kind][0](a).alias(a) for a, kind in extremes.items()),
    )
    found = [F.col("n" if kind == "count" else f"s{i}").alias(name) for i, (name, (kind, _)) in enumerate(summary.items())]
    return whole.select(*(F.col(a).alias(c) for a, c in own.items()), *found)


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    point: str,
    low: str,
    high: str,
    keys: list[str] | None = None,
    max_bin_rows: int = MAX_BIN_ROWS,
    summary: dict[str, tuple[str, str | None]] | None = None,
) -> DataFrame:
    """Every pair of a point and an interval with `low <= point < high` and equal `keys`.

    All columns of `points`, then those of `intervals` but the keys; other names must
    differ. `point`, `low` and `high` are whole numbers, dates or timestamps, of one
    kind. A null `high` is open: it lies behind every point; a null `low` before.
    Null points and null keys match nothing, nor does an interval whose end is not
    behind its start. Repeated rows match as often as they stand. `max_bin_rows`
    decides how the work is dealt out, never what comes out.

    With `summary`, an interval comes once and not once per point, if it holds any:
    its columns, keys first, then of its points what each name says, `("count", None)`,
    `("min", column)` or `("max", column)`. No pair is made, so no bin is either.
    """
    keys = list(keys or [])
    clash = {c.lower() for c in points.columns} & {c.lower() for c in intervals.columns} - {k.lower() for k in keys}
    if clash:
        raise ValueError(f"both tables have {sorted(clash)}; rename them in one")
    kinds = {type(t.schema[c].dataType) if not isinstance(t.schema[c].dataType, T.IntegralType) else T.IntegralType
             for t, c in ((points, point), (intervals, low), (intervals, high))}
    if len(kinds) > 1:
        raise TypeError(f"{point}, {low} and {high} must be of one kind")
    if summary is not None:
        return _summed(points, intervals, point, low, high, keys, summary)
    n = _Names.of(points, intervals)
    placed = points.withColumn(n.at, _position(points, point)).filter(F.col(n.at).isNotNull())
    met = None
    if keys:
        placed, intervals, met = _of_shared_keys(placed, intervals, keys)
    count, first, last = placed.agg(F.count(F.lit(1)), F.min(n.at), F.max(n.at)).first()
    if not count:
        first = last = 0
    # No point lies outside, so nothing of an interval there matters.
    bounded = intervals.withColumns(
        {
            n.low: F.greatest(F.coalesce(_position(intervals, low), F.lit(first)), F.lit(first)),
            n.high: F.least(F.coalesce(_position(intervals, high), F.lit(last + 1)), F.lit(last + 1)),
        }
    ).filter(F.col(n.low) < F.col(n.high))
    length_class = _class_of(F.col(n.high) - F.col(n.low))
    lengths = {r["c"]: r["n"] for r in bounded.groupBy(length_class.alias("c")).agg(F.count(F.lit(1)).alias("n")).collect()}
    levels = choose_levels(lengths, count, last - first, met) or {0: 0}
    level_of = F.create_map(*(F.lit(int(x)) for pair in sorted(levels.items()) for x in pair))
    # A bin's number is a position's leading bits, whatever its sign.
    ranged = bounded.withColumn(n.level, level_of[length_class]).withColumn(
        n.bin,
        F.explode(
            F.sequence(
                F.call_function("shiftright", F.col(n.low), F.col(n.level)),
                F.call_function("shiftright", F.col(n.high) - 1, F.col(n.level)),
            )
        ),
    )
    used = F.array(*(F.lit(int(x)) for x in sorted(set(levels.values()))))
    binned = placed.withColumn(n.level, F.explode(used)).withColumn(
        n.bin, F.call_function("shiftright", F.col(n.at), F.col(n.level))
    )
    on = [*(quoted(k) for k in keys), n.level, n.bin]
    plain = [*keys, n.level, n.bin]
    for key in on[: len(keys)]:
        binned, ranged = binned.filter(F.col(key).isNotNull()), ranged.filter(F.col(key).isNotNull())
    binned, ranged = _split(binned, ranged, plain, n, max_bin_rows)
    met = binned.join(ranged, [*plain, n.row, n.column])
    inside = met.filter((F.col(n.low) <= F.col(n.at)) & (F.col(n.at) < F.col(n.high)))
    others = [c for c in intervals.columns if c.lower() not in {k.lower() for k in keys}]
    return inside.select(*(quoted(c) for c in [*points.columns, *others]))
