"""Operator 12: hard negatives by the threshold algorithm.

Rows are dealt to blocks of bounded size, ordered by label. Every block keeps, per
dimension, its rows sorted by that component. For an anchor, sorted access goes
down all these lists at once, from the top where the anchor's component is
positive and from the bottom where it is negative; rows that turn up are scored in
full by random access. The sum of what the lists hold at the current depth bounds
every row not seen yet; once that threshold is strictly below the last place of
each of the anchor's windows, the block is done.

There are two passes over blocks: one finds each anchor's positives, which set its
windows, and one fills the windows. A block is replicated for each slice of the
anchors; what comes back is a few rows per anchor and block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commitlens.scratch import stored

# Rows of a block.
BLOCK_ROWS = 1 << 14
# Anchors that a block's task works through; a block is replicated for each so many.
SLICE_ANCHORS = 1 << 13
# Depth of the first step of sorted access; steps double.
_FIRST_STEP = 8
_LONG = 2**63 - 1


# --- The threshold algorithm, on one block ---------------------------------------


class Lists:
    """Some rows of a block with their per-dimension sorted lists, largest component first."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.order = np.argsort(-vectors, axis=0, kind="stable").astype(np.int32)
        self.sorted = np.take_along_axis(vectors, self.order, axis=0)


class Places:
    """The first `k` rows with a score in [low, high]; higher scores first, ties by smaller id."""

    def __init__(self, k: int, low: int, high: int):
        self.k, self.low, self.high = k, low, high
        self.scores, self.ids = np.empty(0, np.int64), np.empty(0, np.int64)

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        fits = (scores >= self.floor()) & (scores <= self.high)
        if not fits.any():
            return
        scores, ids = np.concatenate((self.scores, scores[fits])), np.concatenate((self.ids, ids[fits]))
        best = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[best], ids[best]

    def floor(self) -> int:
        """No row below this can enter: the last place's score, or the lower end while places are free."""
        return int(self.scores[-1]) if len(self.scores) == self.k else self.low


def threshold_search(lists: Lists, anchor: np.ndarray, windows: list[Places], skip: np.ndarray) -> int:
    """Fill the windows from the rows where `skip` is false; returns how many rows were met."""
    n = len(lists.ids)
    used = np.flatnonzero(anchor)
    seen = np.zeros(n, bool)
    depth, step = 0, _FIRST_STEP
    down = anchor[used] > 0
    while depth < n:
        upto = min(n, depth + step)
        # Sorted access: from the head of a list, or from its tail where the anchor is negative.
        head = lists.order[depth:upto, used[down]].ravel()
        tail = lists.order[n - upto : n - depth, used[~down]].ravel()
        met = np.full(n, not len(used))
        met[head] = met[tail] = True
        fresh = np.flatnonzero(met & ~seen & ~skip)
        seen |= met
        # Random access: whole integer products.
        scores = lists.vectors[fresh] @ anchor
        for window in windows:
            window.offer(scores, lists.ids[fresh])
        if upto == n or not len(used):
            break
        at = np.where(down, upto - 1, n - upto)
        threshold = int((lists.sorted[at, used] * anchor[used]).sum())
        if all(threshold < window.floor() for window in windows):
            break
        depth, step = upto, step * 2
    return int(seen.sum())


# --- Rows ------------------------------------------------------------------------

_BLOCK = "block int, ids binary, labels binary, vectors binary, dims int"
_ANCHOR = "anchor long, label long, vector binary, windows array<long>"


def _widened(raw: list[bytes], dims: int) -> np.ndarray:
    """Integer vectors as rows of one table; those with fewer components end in zeros."""
    out = np.zeros((len(raw), dims), np.int64)
    for row, data in zip(out, raw):
        found = np.frombuffer(data, np.int64)
        row[: len(found)] = found
    return out


def _to_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A partition as one row."""
    from pyspark import TaskContext

    ids, labels, raw = [], [], []
    for batch in batches:
        ids += batch.column(0).to_pylist()
        labels += batch.column(1).to_pylist()
        raw += batch.column(2).to_pylist()
    if not ids:
        return
    dims = max(map(len, raw)) // 8
    order = np.lexsort((ids, labels))
    vectors = _widened(raw, dims)[order]
    data = [np.array(x, np.int64)[order].tobytes() for x in (ids, labels)]
    columns = [pa.array([TaskContext.get().partitionId()], pa.int32()), *(pa.array([x]) for x in data),
               pa.array([vectors.tobytes()]), pa.array([dims], pa.int32())]
    yield pa.record_batch(columns, ["block", "ids", "labels", "vectors", "dims"])


class Block:
    """A block's rows, the lists of all of them and those of each label, made when asked for."""

    def __init__(self, row: dict, dims: int):
        self.ids, self.labels = (np.frombuffer(row[c], np.int64) for c in ("ids", "labels"))
        self.vectors = np.zeros((len(self.ids), max(dims, row["dims"])), np.int64)
        self.vectors[:, : row["dims"]] = np.frombuffer(row["vectors"], np.int64).reshape(len(self.ids), row["dims"])
        self.known: dict[int | None, Lists] = {}

    def lists(self, label: int | None) -> Lists:
        if label not in self.known:
            own = slice(None)
            if label is not None:
                own = slice(*np.searchsorted(self.labels, (label, label + 1)))
            self.known[label] = Lists(self.ids[own], self.vectors[own])
        return self.known[label]


def _positives(block: Block, label: int, anchor: int, vector: np.ndarray, k: int) -> Iterator[tuple]:
    lists = block.lists(label)
    if len(lists.ids):
        window = Places(k, -_LONG, _LONG)
        threshold_search(lists, vector, [window], lists.ids == anchor)
        yield from ((anchor, None, i, s) for i, s in zip(window.ids.tolist(), window.scores.tolist()))


def _negatives(block: Block, label: int, anchor: int, vector: np.ndarray, spans: list, k: int) -> Iterator[tuple]:
    """`spans` holds, one after the other, a positive's score and the window's two ends."""
    if block.labels[0] == label == block.labels[-1]:
        return
    ends = [tuple(spans[i : i + 3]) for i in range(0, len(spans), 3)]
    windows = {end: Places(k, *end[1:]) for end in ends if end[1] <= end[2]}
    lists = block.lists(None)
    if windows:
        threshold_search(lists, vector, list(windows.values()), block.labels == label)
    for end, window in windows.items():
        yield from ((anchor, end[0], i, s) for i, s in zip(window.ids.tolist(), window.scores.tolist()))


_FOUND = "anchor long, positive_score long, id long, score long"


def _search(k: int, same_label: bool):
    def search(key: tuple, blocks: pa.Table, packs: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        if blocks.num_rows and packs.num_rows:
            anchors = packs["vector"].to_pylist()
            dims = max(map(len, anchors)) // 8
            block = Block(blocks.to_pylist()[0], dims)
            vectors = _widened(anchors, block.vectors.shape[1])
            for anchor, label, vector, spans in zip(
                packs["anchor"].to_pylist(), packs["label"].to_pylist(), vectors, packs["windows"].to_pylist()
            ):
                if same_label:
                    rows.extend(_positives(block, label, anchor, vector, k))
                else:
                    rows.extend(_negatives(block, label, anchor, vector, spans, k))
        columns = zip(*rows) if rows else [[]] * 4
        names = ["anchor", "positive_score", "id", "score"]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names)

    return search


def _met(
    blocks: DataFrame, n_blocks: int, anchors: DataFrame, n_anchors: int, k: int, same_label: bool, slice_anchors: int
) -> DataFrame:
    """Every anchor against every block, a slice of anchors and a block at a time."""
    n_slices = max(1, -(-n_anchors // slice_anchors))
    slice_of = F.pmod(F.xxhash64("anchor"), F.lit(n_slices)).cast("int")
    dealt = anchors.select(*_names(_ANCHOR), slice_of.alias("slice")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))
    )
    held = blocks.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(n_slices - 1))))
    # The number is given, since rows are few and each of them is much work.
    spread = max(1, n_blocks * n_slices)
    held, dealt = (x.repartition(spread, "block", "slice") for x in (held, dealt))
    met = held.groupBy("block", "slice").cogroup(dealt.groupBy("block", "slice"))
    return met.applyInArrow(_search(k, same_label), _FOUND)


def _names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def integer_vectors(rows: DataFrame, key: str, vector: str, label: Column, scale: int) -> DataFrame:
    """`(id, label, vector)`: components times `scale`, rounded down.

    Rows without a key, label or vector, with a null or non-finite component, or
    with one so large that a score might not fit a long, are left out; of rows with
    one key the first by label, then components, stays.
    """
    good = rows.select(F.col(key).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vector).alias("vector"))
    parts = F.transform("vector", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    most = F.sqrt(F.lit(float(_LONG)) / F.greatest(F.size("vector"), F.lit(1))) - 2
    small = F.forall("vector", lambda x: F.abs(F.lit(float(scale)) * x.cast("double")) < most)
    usable = F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull()
    whole = good.filter(usable).filter(finite).filter(small).select("id", "label", parts.alias("vector"))
    first = whole.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("first"))
    return first.select("id", "first.label", "first.vector")


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes."""
    for batch in batches:
        raw = [np.array(x, np.int64).tobytes() for x in batch.column(2).to_pylist()]
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(raw, pa.binary())], ["id", "label", "vector"])


def mine_hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    label: Column,
    low_percent: int = 80,
    n_positives: int = 5,
    n_negatives: int = 5,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: int = 256,
    block_rows: int = BLOCK_ROWS,
    slice_anchors: int = SLICE_ANCHORS,
) -> DataFrame:
    """`(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`.

    A row's score is the inner product with the anchor of their components, each
    times `scale` and rounded down; higher scores come first, ties by smaller key.
    An anchor's positives are its first `n_positives` other rows of its label. For
    each, the first `n_negatives` rows of other labels come back whose score is at
    most the positive's and at least `low_percent` hundredths of it; so none where
    the positive's score is negative.

    `is_anchor` is a condition over the column `id`, the key; `label` is an
    expression over `rows`. Rows without key, label or vector, or with a null or
    non-finite component, take no part, nor do those whose scores might not fit a
    long. Of rows that repeat a key the first by label, then vector, counts. Shorter vectors end in
    zeros. An empty table gives no row; other columns are not read.
    """
    whole = integer_vectors(rows, key, vector, label, scale)
    vectors = stored(whole.mapInArrow(_packed, "id long, label long, vector binary"))
    n = vectors.count()
    n_blocks = max(1, -(-n // block_rows))
    # By label, so that a block has few of them; a large label spans many blocks.
    dealt = vectors.repartitionByRange(n_blocks, "label", F.xxhash64("id"))
    blocks = stored(dealt.select("id", "label", "vector").mapInArrow(_to_block, _BLOCK))
    chosen = vectors.filter(is_anchor).select(F.col("id").alias("anchor"), "label", "vector")
    n_anchors = chosen.count()
    no_windows = F.array().cast("array<long>").alias("windows")
    near = _met(blocks, n_blocks, chosen.select("*", no_windows), n_anchors, n_positives, True, slice_anchors)
    best = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
    positives = near.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= n_positives)
    positives = stored(positives.select("anchor", F.col("id").alias("positive"), "score"))
    low = F.ceil(F.col("score").cast("decimal(38,0)") * low_percent / 100).cast("long")
    # One window for each score; positives of one score share it.
    windows = positives.groupBy("anchor").agg(
        F.flatten(F.collect_set(F.array("score", low, "score"))).alias("windows")
    )
    hard = _met(blocks, n_blocks, chosen.join(windows, "anchor"), n_anchors, n_negatives, False, slice_anchors)
    along = Window.partitionBy("anchor", "positive_score").orderBy(F.desc("score"), "id")
    ranked = hard.withColumn("rank", F.row_number().over(along)).filter(F.col("rank") <= n_negatives)
    both = positives.withColumnRenamed("score", "positive_score").join(ranked, ["anchor", "positive_score"])
    return both.select(
        F.col("anchor").alias("anchor_id"),
        F.col("positive").alias("positive_id"),
        "rank",
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
