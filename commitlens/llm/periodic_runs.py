"""Operator 13: runs of words that repeat with a period, found tile by tile.

A run of period q is a stretch in which each word equals the one q before it. Its
matches, the positions i with word i equal to word i + q, are one interval of at
least q positions. Periods are dealt with by octaves [P, 2P):

1. While a text is read, hashes of P/4 words tell which of its tiles may hold a
   run of an octave at all: three adjoining windows must recur at one distance.
2. Such tiles become rows of their own, overlapping by more than the longest
   period, and are dealt to tasks. Within a tile, Z-functions to both sides of
   boundaries a fixed distance apart give every interval of matches around them.
3. Intervals are shuffled by document and period and stitched where they touch.
   A stitched run counts if its root is primitive, that is if no shorter period
   has the same run.

No step's memory grows with the number of rows; it is bounded by the longest text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from commitlens.llm.rows import unused_name
from commitlens.llm.tokens import slices
from commitlens.scratch import stored

# Shortest run, in words.
MIN_LENGTH = 12
# Positions of a tile besides its overlap; at least four times the octave's longest period.
TILE = 1024
# Positions that one task should solve, some seconds' work.
TASK_POSITIONS = 1 << 20
# Cells of the window comparison that are held at a time.
_CELLS = 1 << 21

Words = Callable[[int | None, str | None], list[bytes]]


def words_of(key: int | None, text: str | None) -> list[bytes]:
    """Words between blanks and ASCII line ends and tabs; a null text has none."""
    return (text or "").encode().split()


def _shortest_match(period: int, least: int) -> int:
    """How many matches a run of this period has at least."""
    return max(least, 2 * period) - period


def _needed(octave: int, least: int) -> int:
    """Fewest matches of a run of any period in the octave."""
    return min(_shortest_match(q, least) for q in range(octave, min(2 * octave, max(octave, least) + 1)))


def _octaves(n: int) -> list[int]:
    """Octaves whose periods fit twice into `n` words."""
    return [1 << k for k in range(max(0, n // 2).bit_length())]


# --- Which tiles may hold a run --------------------------------------------------


def _window_hashes(ids: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """`(length, hash of the window at each position)` for lengths 1, 2, 4 and so on."""
    hashes, length = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), 1
    while length <= len(ids):
        yield length, hashes
        with np.errstate(over="ignore"):
            mixed = hashes[:-length] * np.uint64(0xD6E8FEB86659FD93) + hashes[length:] if length < len(hashes) else hashes[:0]
            hashes = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xA0761D6478BD642F)
        length *= 2


def _recurring(hashes: np.ndarray, window: int, first: int, last: int) -> np.ndarray:
    """Positions with three adjoining windows that all recur at one distance in [first, last)."""
    count, spread = len(hashes) // window + 1, last - first
    # Behind the last text nothing recurs.
    padded = np.concatenate((hashes, np.zeros(last + 4 * window, np.uint64)))
    found, step = [], max(4, _CELLS // spread)
    for at in range(0, count, step):
        rows = min(step, count - at) + 2
        base = at * window
        later = np.lib.stride_tricks.as_strided(
            padded[base + first :], (rows, spread), (window * padded.itemsize, padded.itemsize), writeable=False
        )
        same = later == padded[base : base + rows * window : window, None]
        hits = (same[:-2] & same[1:-1] & same[2:]).any(axis=1)
        found.append((np.flatnonzero(hits) + at) * window)
    places = np.concatenate(found)
    return places[places < len(hashes)]


def _long_matches(ids: np.ndarray, period: int, least: int) -> np.ndarray:
    """Middles of the stretches of at least `least` matches at this distance."""
    differ = np.flatnonzero(ids[:-period] != ids[period:])
    edges = np.concatenate(([-1], differ, [len(ids) - period]))
    gaps = np.diff(edges)
    long = np.flatnonzero(gaps > least)
    # Every stride of a long stretch, so that each of its tiles is found.
    return np.concatenate([np.arange(edges[i] + 1, edges[i + 1], 8) for i in long]) if len(long) else long


def likely_places(ids: np.ndarray, lengths: np.ndarray, least: int = MIN_LENGTH) -> dict[int, np.ndarray]:
    """For each octave, positions near which some text may have a run of it.

    `ids` holds texts end to end, longest first, each with an id of its own behind
    it; `lengths` count that id. Every run has such a position among its matches.
    """
    ends = np.cumsum(lengths)
    windows = _window_hashes(ids)
    length, hashes = next(windows, (1, ids))
    out = {}
    for octave in _octaves(int(lengths[0]) - 1 if len(lengths) else 0):
        fitting = int(ends[np.searchsorted(-lengths, -(2 * octave)) - 1])
        if octave < 8:
            places = [_long_matches(ids[:fitting], q, _shortest_match(q, least)) for q in range(octave, 2 * octave)]
            out[octave] = np.unique(np.concatenate(places))
            continue
        # Four windows fit into the matches of any run, so three aligned ones do.
        while length < octave // 4:
            length, hashes = next(windows)
        out[octave] = _recurring(hashes[: max(0, fitting - length + 1)], length, octave, 2 * octave)
    return {octave: places for octave, places in out.items() if len(places)}


# --- One tile --------------------------------------------------------------------


def z_function(s: list[int]) -> list[int]:
    """For each position, how many elements from there on equal those from the start on."""
    n = len(s)
    z, left, right = [0] * n, 0, 0
    for i in range(1, n):
        k = min(z[i - left], right - i) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        if i + k > right:
            left, right = i, i + k
        z[i] = k
    return z


def tile_span(octave: int, least: int) -> tuple[int, int]:
    """Stride of the octave's tiles, and how many positions of matches a tile covers."""
    stride = max(TILE, 8 * octave)
    # The overlap exceeds the matches of the shortest run, at most the period or the least length.
    return stride, stride + 2 * octave + least


def tile_matches(words: list[int], octave: int, span: int, least: int = MIN_LENGTH) -> list[tuple[int, int, int]]:
    """`(period, start, stop)`: intervals of matches among the first `span` positions.

    Only those long enough for a run, and only periods of the octave.
    """
    step = max(octave, min(8, _needed(octave, least)))
    span = min(span, len(words) - octave)
    pieces: dict[int, list[list[int]]] = {}
    for b in range(0, max(0, span), step):
        begin = max(0, b - step)
        ahead = z_function(words[b : min(len(words), b + step + 2 * octave)])
        reach = min(2 * octave, len(words) - b)
        # Backwards from the boundary against backwards from each later position.
        before = words[begin:b][::-1]
        back = z_function(before + [-1] + words[begin : b + reach - 1][::-1]) if before else []
        turned = len(before) + reach
        for q in range(octave, reach):
            right = min(step, ahead[q], span - b)
            left = back[turned - q] if before else 0
            if left + right == 0:
                continue
            start, stop = b - left, b + right
            known = pieces.setdefault(q, [])
            if known and start <= known[-1][1]:
                known[-1][1] = max(known[-1][1], stop)
            else:
                known.append([start, stop])
    return [
        (q, start, stop)
        for q, known in sorted(pieces.items())
        for start, stop in known
        if stop - start >= _shortest_match(q, least)
    ]


def _primitive(words: list[int], start: int, period: int) -> bool:
    """Has the run with this root no period that divides its own?"""
    root, rest, factor = words[start : start + period], period, 2
    while rest > 1:
        if factor * factor > rest:
            factor = rest
        if rest % factor == 0:
            shorter = period // factor
            if root[shorter:] == root[:-shorter]:
                return False
            while rest % factor == 0:
                rest //= factor
        factor += 1
    return True


# --- Rows ------------------------------------------------------------------------

_READ = "uid long, key long, n_words long, sha string, words binary, tiles array<struct<octave:int,start:long>>"
_TILE = "uid long, octave int, start long, span int, ids binary"


def _joined_sha(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _identified(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts' words end to end, an id of its own behind each text, and lengths with it."""
    table: dict[bytes, int] = {}
    number = table.setdefault
    ids: list[int] = []
    for at, words in enumerate(texts):
        ids.extend([number(word, len(table)) for word in words])
        ids.append(-1 - at)
    return np.array(ids, np.int64), np.array([len(words) + 1 for words in texts], np.int64)


def _tiles_of(texts: list[list[bytes]], least: int) -> dict[int, set[tuple[int, int]]]:
    """For each text, by its place in the list, `(octave, start)` of the tiles that may hold a run."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    ids, lengths = _identified([texts[i] for i in order])
    ends = np.cumsum(lengths)
    out: dict[int, set[tuple[int, int]]] = {}
    for octave, places in likely_places(ids, lengths, least).items():
        stride, span = tile_span(octave, least)
        which = np.searchsorted(ends, places, "right")
        inside = places - (ends - lengths)[which]
        # All tiles that the matches around a place reach into.
        lowest, highest = (inside - 2 * (span - stride)) // stride, (inside + span - stride) // stride
        for shift in range(int((highest - lowest).max()) + 1):
            number = lowest + shift
            real = (number >= 0) & (number <= highest) & (number * stride < lengths[which] - octave)
            for place, start in set(zip(which[real].tolist(), (number[real] * stride).tolist())):
                out.setdefault(order[place], set()).add((octave, start))
    return out


def _read(words: Words, least: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        uid = TaskContext.get().partitionId() << 33
        for batch in batches:
            for part in slices(batch):
                keys = part.column(0).to_pylist()
                texts = [words(key, text) for key, text in zip(keys, part.column(1).to_pylist())]
                tiles = _tiles_of(texts, least)
                rows = []
                for i, (key, found) in enumerate(zip(keys, texts)):
                    own = [{"octave": o, "start": s} for o, s in sorted(tiles.get(i, ()))]
                    # Texts that may have a run come back once their runs are known.
                    rows.append((uid, key, len(found), None if own else _joined_sha(found), b" ".join(found) if own else None, own))
                    uid += 1
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(),
                         pa.list_(pa.struct([("octave", pa.int32()), ("start", pa.int64())]))]
                names = ["uid", "key", "n_words", "sha", "words", "tiles"]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return read


def _explode(least: int):
    """A row per tile, with the word ids that it needs."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                row = part.to_pylist()[0]
                ids = _identified([row["words"].split()])[0][:-1].astype(np.uint32)
                rows = []
                for octave, start in (tile.values() for tile in row["tiles"]):
                    span = tile_span(octave, least)[1]
                    rows.append((row["uid"], octave, start, span, ids[start : start + span + 2 * octave].tobytes()))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary()]
                names = ["uid", "octave", "start", "span", "ids"]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return explode


def _solve(least: int):
    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 64):
                rows = []
                for uid, octave, start, span, ids in zip(*(c.to_pylist() for c in part.columns)):
                    words = np.frombuffer(ids, np.uint32).tolist()
                    for q, begin, stop in tile_matches(words, octave, span, least):
                        rows.append((uid, q, start + begin, start + stop, _primitive(words, begin, q)))
                if rows:
                    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
                    names = ["uid", "period", "start", "stop", "primitive"]
                    yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return solve


def _stitched(fragments: DataFrame) -> DataFrame:
    """Intervals of one text and period that touch become one."""
    along = Window.partitionBy("uid", "period").orderBy("start", "stop")
    reached = F.max("stop").over(along.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce((F.col("start") > reached).cast("long"), F.lit(1))
    return (
        fragments.withColumn("opens", opens)
        .withColumn("run", F.sum("opens").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .groupBy("uid", "period", "run")
        .agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
        .select("uid", "start", (F.col("stop") - F.col("start") + F.col("period")).alias("length"), "period")
    )


def _dropped(n: int, runs: list[dict]) -> np.ndarray:
    """Which words stand in a run after its first period."""
    change = np.zeros(n + 1, np.int64)
    for run in runs:
        change[run["start"] + run["period"]] += 1
        change[run["start"] + run["length"]] -= 1
    return np.cumsum(change[:n]) > 0


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, 1):
            row = part.to_pylist()[0]
            words, runs = row["words"].split(), row["runs"] or []
            drop = _dropped(len(words), runs)
            kept = [word for word, gone in zip(words, drop.tolist()) if not gone]
            yield pa.record_batch([pa.array([row["uid"]]), pa.array([_joined_sha(kept)])], ["uid", "sha"])


def periodic_runs(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    min_length: int = MIN_LENGTH,
    words: Words = words_of,
) -> DataFrame:
    """`(key, n_words, runs, collapsed_sha256)` of every row.

    `runs` holds `(start, length, period)` of each longest stretch of words that
    repeats with `period`, its smallest, for at least two periods and `min_length`
    words, by start, then period; an empty array if there is none.
    `collapsed_sha256` is of the words joined by blanks, without those that stand in
    a run after its first period. `words` splits a row's text, given its key.

    A null or empty text has no words. Rows with null or repeated keys are texts of
    their own. An empty table gives no row; columns other than key and text are
    not read.
    """
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    seen = stored(rows.mapInArrow(_read(words, min_length), _READ))
    likely = seen.filter("words IS NOT NULL")
    tiles = likely.select("uid", "words", "tiles").mapInArrow(_explode(min_length), _TILE)
    # Dealt out anew: a long text's tiles are many, and lie in one task until here.
    each = F.transform("tiles", lambda t: F.greatest(F.lit(TILE), 8 * t["octave"]).cast("long"))
    work = likely.agg(F.sum(F.aggregate(each, F.lit(0).cast("long"), lambda x, y: x + y))).first()[0] or 0
    dealt = tiles.repartition(-(-work // TASK_POSITIONS) or 1, F.xxhash64("uid", "octave", "start"))
    fragments = stored(dealt.mapInArrow(_solve(min_length), "uid long, period long, start long, stop long, primitive boolean"))
    # All pieces of a run agree on whether its root is primitive.
    runs = _stitched(fragments.filter("primitive").drop("primitive")).groupBy("uid").agg(
        F.sort_array(F.collect_list(F.struct("start", "length", "period"))).alias("runs")
    )
    runs = runs.select("uid", F.transform("runs", lambda r: F.struct(r["start"].alias("start"), r["length"].alias("length"), r["period"].alias("period"))).alias("runs"))
    known = stored(runs)
    light = likely.select("uid", "words").join(known, "uid", "left")
    collapsed = light.mapInArrow(_collapse, "uid long, sha string").withColumnRenamed("sha", "collapsed")
    none = F.array().cast("array<struct<start:bigint,length:bigint,period:bigint>>")
    return (
        seen.select("uid", "key", "n_words", "sha")
        .join(known, "uid", "left")
        .join(stored(collapsed), "uid", "left")
        .select(
            F.col("key").alias(key),
            "n_words",
            F.coalesce("runs", none).alias("runs"),
            F.coalesce("sha", "collapsed").alias("collapsed_sha256"),
        )
    )


def run_digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per text: number of runs, the longest (ties: first, then shortest period), and digests.

    `exponent_milli` is how often the longest run's period fits into it, in thousandths.
    """
    longest = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    )
    best = unused_name(found, "__best")
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    start, length, period = -F.col(best)["start"], F.col(best)["length"], -F.col(best)["period"]
    return found.withColumn(best, longest).select(
        key,
        F.size("runs").cast("long").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.expr(f"1000 * {best}.length div -{best}.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        "collapsed_sha256",
        "n_words",
    )
