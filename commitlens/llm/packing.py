"""Operator 5: packing token pieces into sequences by a configuration program.

Only the histogram of piece lengths reaches the driver: at most one number per
length. A configuration is a multiset of lengths that fits one sequence; the
program asks for the fewest configurations, in fractions, that cover the
histogram. It is solved by multiplicative weights: a knapsack dynamic program
prices configurations, the program steps along the dearest ones, and the weight
of what they cover shrinks. Any weights give a bound that no packing can beat.

The first weights are the lengths themselves, whose bound is the volume; weights and
solution are improved in rounds until bound and solution meet, or for `ROUNDS`. Rounding takes whole configurations while
the histogram has pieces for them; what the fractions leave is packed best fit.
Pieces then find their place by their rank among the pieces of their length.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from commitlens.llm.tokens import encoder, slices
from commitlens.scratch import stored

# Most of a length's count that one round of the first solution covers.
STEP = 0.25
# Rounds of multiplicative weights at most, how fast weights shrink, and the share by
# which solution and bound may differ.
ROUNDS, RATE, GAP = 1500, 0.05, 0.002
# Configurations that one round steps along, all nearly as dear as the dearest.
_PER_ROUND, _NEARLY = 4, 0.95


# --- The program over the histogram, on plain arrays -----------------------------


def _knapsack(price: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best worth of each capacity and the length taken first there; 0 takes none.

    `price[l]` is the worth of one piece of length l; pieces may repeat.
    """
    best, taken = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    lengths = np.flatnonzero(price > 0)
    worth = price[lengths]
    for c in range(1, capacity + 1):
        n = np.searchsorted(lengths, c, "right")
        best[c] = best[c - 1]
        if n:
            value = best[c - lengths[:n]] + worth[:n]
            i = int(value.argmax())
            if value[i] > best[c]:
                best[c], taken[c] = value[i], lengths[i]
    return best, taken


def _filled(taken: np.ndarray, room: int, open_: np.ndarray) -> list[int]:
    """What the dynamic program puts into `room`; where that is used up, the longest that is not."""
    out = []
    while room > 0:
        length = int(taken[room])
        if not length or not open_[length]:
            # Position of the last open length up to `room`.
            length = room - int(open_[room::-1].argmax())
            if not open_[length]:
                break
        out.append(length)
        room -= length
    return out


def solve_configurations(
    counts: dict[int, int], capacity: int, step: float = STEP
) -> list[tuple[tuple[int, ...], float]]:
    """`(configuration, how often)`, fractional, covering every length's count exactly.

    A piece is worth its share of the sequence to the power 1.05. From the longest
    length down, a round steps along the dearest configuration with that length,
    until `step` of every count is covered. No price reacts to what is covered.
    """
    demand, used = np.zeros(capacity + 1), defaultdict(float)
    for length, n in counts.items():
        demand[length] = n
    left, size = demand.copy(), np.arange(capacity + 1) / capacity
    tiny = 1e-9 * np.maximum(demand, 1)
    while (open_ := left > tiny).any():
        _, taken = _knapsack(np.where(open_, size**1.05, 0.0), capacity)
        quota = np.minimum(left, step * demand)
        open_ = quota > tiny
        for length in np.flatnonzero(open_)[::-1].tolist():
            while open_[length]:
                pieces = Counter([length, *_filled(taken, capacity - length, open_)])
                amount = min(quota[x] / k for x, k in pieces.items())
                used[tuple(sorted(pieces.elements(), reverse=True))] += amount
                for x, k in pieces.items():
                    quota[x] -= k * amount
                    left[x] -= k * amount
                    open_[x] = quota[x] > tiny[x]
    return list(used.items())


def _dearest(price: np.ndarray, best: np.ndarray, taken: np.ndarray, capacity: int) -> list[Counter]:
    """Some of the dearest configurations, each with another length in it, the dearest first."""
    lengths = np.flatnonzero(price > 0)
    worth = price[lengths] + best[capacity - lengths]
    out, met = [], set()
    for i in np.argsort(-worth, kind="stable").tolist():
        if worth[i] < _NEARLY * best[capacity] or len(out) == _PER_ROUND:
            break
        if int(lengths[i]) in met:
            continue
        pieces, room = Counter([int(lengths[i])]), capacity - int(lengths[i])
        while room > 0:
            if taken[room]:
                pieces[int(taken[room])] += 1
            room -= int(taken[room]) or 1
        out.append(pieces)
        met.update(pieces)
    return out


def solve_program(
    counts: dict[int, int], capacity: int, rounds: int = ROUNDS, rate: float = RATE, gap: float = GAP
) -> tuple[list[tuple[tuple[int, ...], float]], float]:
    """Covering program by multiplicative weights: `(configuration, how often)`, and the bound.

    The solution covers every count at least; the bound is the dearest dual met.
    """
    demand = np.zeros(capacity + 1)
    for length, n in counts.items():
        demand[length] = n
    some = demand > 0
    if not some.any():
        return [], 0.0
    size = np.arange(capacity + 1) / capacity
    price = np.where(some, size, 0.0)
    used: dict[tuple[int, ...], float] = defaultdict(float)
    covered, bound = np.zeros(capacity + 1), 0.0
    for done in range(1, rounds + 1):
        best, taken = _knapsack(price, capacity)
        bound = max(bound, float(demand @ price) / best[capacity])
        for pieces in _dearest(price, best, taken, capacity):
            amount = min(demand[x] / k for x, k in pieces.items())
            used[tuple(sorted(pieces.elements(), reverse=True))] += amount
            for x, k in pieces.items():
                covered[x] += k * amount
        # Prices shrink with what is covered of a count.
        share = covered[some] / demand[some]
        price[some] = size[some] * np.exp(-rate * (share - share.min()))
        if share.min() > 0 and done % 25 == 0 and sum(used.values()) / share.min() <= bound * (1 + gap):
            break
    least = (covered[some] / demand[some]).min()
    return [(c, amount / least) for c, amount in used.items()] if least > 0 else [], bound


def _best_fit(counts: dict[int, int], groups: Counter, capacity: int) -> Counter:
    """Best fit, longest first, on groups of like sequences `(lengths) -> how many`."""
    by_room: dict[int, Counter] = defaultdict(Counter)
    for lengths, n in groups.items():
        by_room[capacity - sum(lengths)][lengths] += n
    rooms = np.zeros(capacity + 1, np.int64)
    for room, found in by_room.items():
        rooms[room] = found.total()
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            fits = np.flatnonzero(rooms[length:])
            room = length + int(fits[0]) if len(fits) else capacity
            if not len(fits):
                # New sequences take as many of this length as they hold.
                each = capacity // length
                full, rest = divmod(left, each)
                made = Counter({(length,) * each: full, (length,) * rest: 1 if rest else 0})
                for lengths, n in (+made).items():
                    by_room[capacity - sum(lengths)][lengths] += n
                    rooms[capacity - sum(lengths)] += n
                break
            lengths, n = next(iter(by_room[room].items()))
            n = min(n, left)
            by_room[room][lengths] -= n
            if not by_room[room][lengths]:
                del by_room[room][lengths]
            by_room[room - length][(*lengths, length)] += n
            rooms[room] -= n
            rooms[room - length] += n
            left -= n
    out: Counter = Counter()
    for found in by_room.values():
        out.update(found)
    return +out


def round_configurations(
    solution: list[tuple[tuple[int, ...], float]], counts: dict[int, int], capacity: int
) -> Counter:
    """Whole sequences `(lengths) -> how many` that hold every piece exactly once."""
    left, groups = Counter(counts), Counter()

    def take(configuration: tuple[int, ...], most: int) -> None:
        pieces = Counter(configuration)
        n = min([most, *(left[x] // k for x, k in pieces.items())])
        if n > 0:
            groups[configuration] += n
            for x, k in pieces.items():
                left[x] -= k * n

    # Full sequences first: what they leave waste least.
    ordered = sorted(solution, key=lambda s: (sum(s[0]) < capacity, -s[1], s[0]))
    for configuration, amount in ordered:
        take(configuration, int(amount))
    for configuration, amount in ordered:
        if sum(configuration) == capacity:
            take(configuration, 1 if amount % 1 >= 0.5 else 0)
    return _best_fit(+left, groups, capacity)


def plan_sequences(counts: dict[int, int], capacity: int) -> Counter:
    """Sequences `(lengths) -> how many` for one histogram: the program's solution, rounded."""
    solution, _ = solve_program(counts, capacity)
    return round_configurations(solution, counts, capacity)


def volume_bound(counts: dict[int, int], capacity: int) -> int:
    """No packing has fewer sequences: all lengths over the capacity, rounded up."""
    return -(-sum(length * n for length, n in counts.items()) // capacity)


class Places:
    """Where the r-th piece of a length goes; as large as the list of configurations."""

    def __init__(self, groups: Counter):
        rows, base, seen = [], 0, Counter()
        for lengths, n in sorted(groups.items(), reverse=True):
            at = 0
            for length in lengths:
                rows.append((length, seen[length], base, at))
                seen[length] += n
                at += length
            base += n
        rows.sort()
        table = np.array(rows, np.int64).reshape(-1, 4)
        self.first = (table[:, 0] << 44) + table[:, 1]
        self.base, self.offset = table[:, 2] - table[:, 1], table[:, 3]

    def of(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of each piece."""
        at = np.searchsorted(self.first, (length << 44) + rank, "right") - 1
        return self.base[at] + rank, self.offset[at]


# --- Over the documents ----------------------------------------------------------

_PIECES = "task int, rank long, key long, piece int, start long, length long, ids_crc32 long"


def _cut(tokenizer: str, end_id: int, capacity: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, ranks = TaskContext.get().partitionId(), Counter()
        encode = encoder(tokenizer)
        for batch in batches:
            for part in slices(batch):
                rows = []
                for key, ids in zip(part.column(0).to_pylist(), encode.encode(part.column(1).to_pylist())):
                    ids += end_id.to_bytes(4, "little")
                    for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                        here = ids[at : at + 4 * capacity]
                        length = len(here) // 4
                        rows.append((task, ranks[length], key, piece, at // 4, length, zlib.crc32(here)))
                        ranks[length] += 1
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                names = ["task", "rank", "key", "piece", "start", "length", "ids_crc32"]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return cut


def cut_documents(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Every text's ids and `end_id`, as pieces of at most `capacity`; stored, without the ids.

    `rank` numbers the pieces of one length within one `task`.
    """
    rows = docs.select(F.col(key).cast("long"), F.col(text).cast("string"))
    return stored(rows.mapInArrow(_cut(tokenizer, end_id, capacity), _PIECES))


def _placed(places):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            sequence, offset = places.value.of(length, rank)
            kept = [batch.column(c) for c in ("key", "piece", "start", "length", "ids_crc32")]
            yield pa.record_batch(
                [*kept, pa.array(sequence), pa.array(offset)],
                ["key", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return place


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    capacity: int = 2048,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """`(key, piece, start, length, ids_crc32, sequence_id, offset)`, one row per piece.

    A document's ids are its text's and one `end_id`; it is cut only if it has more
    than `capacity`, into pieces of that many and a last one. A sequence's pieces
    fill it from offset 0 without gaps. Which of several pieces of one length
    goes where is not fixed.

    A null text is empty and has one piece of one id. Rows with a null or repeated
    key are documents of their own. An empty table has no piece. Columns other
    than key and text are not read.
    """
    spark = docs.sparkSession
    pieces = cut_documents(docs, tokenizer, end_id, capacity, key, text)
    per_task = pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    # At most `capacity` rows.
    histogram = per_task.groupBy("length").agg(F.sum("n")).collect()
    places = Places(plan_sequences({int(x): int(n) for x, n in histogram}, capacity))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_task.select(
        "task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")
    )
    ranked = pieces.join(offsets, ["task", "length"]).withColumn("rank", F.col("rank") + F.col("before"))
    schema = "key long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return (
        ranked.select("length", "rank", "key", "piece", "start", "ids_crc32")
        .mapInArrow(_placed(spark.sparkContext.broadcast(places)), schema)
        .withColumnRenamed("key", key)
    )
