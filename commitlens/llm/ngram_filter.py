"""Operator 8: language-model scores from a log-frequency Bloom filter.

An n-gram's count c is held as its quantised logarithm: the filter gets the n-gram
with every level from 1 to 1 + log(c). A reader probes level after level until
one is missing. The filter is built in segments, one per range of n-gram hashes,
each by the task that counted them; segments are broadcast in slices of bounded
size, as many slices as the corpus needs, and every n-gram is probed in its own.

Texts are kept in chunks of token numbers with a list of the chunk's words. The
exact word counts behind the base score come back to the chunks by shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commitlens.llm.rows import arrow_bytes
from commitlens.llm.tokens import slices
from commitlens.scratch import stored

# Tokens of a chunk, after which it is closed with the text that fills it.
CHUNK_TOKENS = 1 << 19
# Counted entries that one counting group should have.
BUCKET_ENTRIES = 1 << 19
# Levels are powers of this.
LEVEL_BASE = 2**0.5
BITS_PER_ENTRY = 14
# Bits that an entry sets, all in one 64-bit word.
BITS_SET = 5
# Largest slice of the filter that is broadcast at once.
SLICE_BYTES = 64 << 20
# Pairs of words seen less often than this are left to the smoothing.
MIN_PAIR_COUNT = 2
# A chunk row is a few megabytes; no more of them go to a worker at a time than one or two.
ARROW_BYTES = 8 << 20
# Weight of the word's own frequency against the pair's.
PRIOR = 300.0
# No word holds a blank.
END = xxhash.xxh3_64_intdigest(b"\x20end")


# --- Hashes and the filter, on plain arrays ---------------------------------------


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return _mix(first * np.uint64(0x9E3779B97F4A7C15) + _mix(second))


def levels_of(counts: np.ndarray, least: int = 1) -> np.ndarray:
    """Quantised logarithm: 0 below `least`, else 1 + the number of whole steps up to the count."""
    out = np.zeros(len(counts), np.int64)
    some = counts >= least
    out[some] = 1 + np.floor(np.log(counts[some] / least) / np.log(LEVEL_BASE) + 1e-9).astype(np.int64)
    return out


def count_of(levels: np.ndarray, least: int = 1) -> np.ndarray:
    """The middle of what a level stands for, 0 for level 0."""
    low = np.ceil(least * LEVEL_BASE ** (levels - 1.0) - 1e-9)
    high = np.maximum(low, np.ceil(least * LEVEL_BASE ** (levels * 1.0) - 1e-9) - 1)
    return np.where(levels > 0, np.sqrt(low * high), 0.0)


def _bits(hashes: np.ndarray, level: int, words: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
    """Word, of so many, and bits of each n-gram at one level."""
    with np.errstate(over="ignore"):
        h = _mix(hashes + np.uint64(level * 0xD1B54A32D192ED03 & (2**64 - 1)))
    at = (h >> np.uint64(32)) % np.asarray(words, np.uint64)
    bits = np.zeros(len(h), np.uint64)
    for i in range(BITS_SET):
        bits |= np.uint64(1) << ((h >> np.uint64(6 * i)) & np.uint64(63))
    return at.astype(np.int64), bits


def build_segment(hashes: np.ndarray, counts: np.ndarray, least: int = 1) -> np.ndarray:
    """Filter words that hold these n-grams; a fixed number of bits for each entry."""
    levels = levels_of(counts, least)
    words = np.zeros(max(1, int(levels.sum()) * BITS_PER_ENTRY // 64), np.uint64)
    for level in range(1, int(levels.max(initial=0)) + 1):
        at, bits = _bits(hashes[levels >= level], level, len(words))
        np.bitwise_or.at(words, at, bits)
    return words


class Segments:
    """Some of a filter's segments, laid end to end; those that are missing hold nothing."""

    def __init__(self, buckets: int, found: dict[int, bytes]):
        self.sizes, self.bases = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        at = 0
        for bucket, raw in found.items():
            self.sizes[bucket], self.bases[bucket] = len(raw) // 8, at
            at += len(raw) // 8
        self.raw = b"".join(found.values())

    def levels(self, hashes: np.ndarray, buckets: np.ndarray) -> np.ndarray:
        """Level of each n-gram: probes from level 1 on until one is missing."""
        words = np.frombuffer(self.raw, np.uint64)
        out, level = np.zeros(len(hashes), np.uint8), 1
        alive = np.flatnonzero(self.sizes[buckets])
        while len(alive) and level < 255:
            own = buckets[alive]
            at, bits = _bits(hashes[alive], level, self.sizes[own])
            alive = alive[(words[self.bases[own] + at] & bits) == bits]
            out[alive] = level
            level += 1
        return out


def _bucket(hashes: np.ndarray, bucket_bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bucket_bits)).astype(np.int64) if bucket_bits else np.zeros(len(hashes), np.int64)


def _cuts(sorted_buckets: np.ndarray, n: int) -> np.ndarray:
    return np.searchsorted(sorted_buckets, np.arange(n + 1))


# --- Chunks ----------------------------------------------------------------------

_CHUNK = (
    "chunk long, keys array<long>, train array<boolean>, ends binary, ids binary, vocabulary binary, "
    "end_id long, n_tokens long"
)


def _planes(ids: np.ndarray) -> bytes:
    """Numbers byte by byte, all lowest bytes first, as few bytes each as the largest needs."""
    width = max(1, (int(ids.max(initial=0)).bit_length() + 7) // 8)
    return ids.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width].T.tobytes()


def _ids(row: dict) -> np.ndarray:
    """A chunk's token numbers; every text has one token at least."""
    n = int(np.frombuffer(row["ends"], np.int64)[-1])
    planes = np.frombuffer(row["ids"], np.uint8).reshape(-1, n)
    out = np.zeros((n, 4), np.uint8)
    out[:, : len(planes)] = planes.T
    return out.view("<u4").ravel()


def _chunk_row(chunk: int, keys: list, train: list, parts: list[np.ndarray]) -> pa.RecordBatch:
    hashes = np.concatenate(parts)
    vocabulary, ids = np.unique(hashes, return_inverse=True)
    ends = np.cumsum([len(p) for p in parts], dtype=np.int64)
    return pa.record_batch(
        [
            pa.array([chunk], pa.int64()),
            pa.array([keys], pa.list_(pa.int64())),
            pa.array([train], pa.list_(pa.bool_())),
            pa.array([ends.tobytes()], pa.binary()),
            pa.array([_planes(ids)], pa.binary()),
            pa.array([vocabulary.tobytes()], pa.binary()),
            pa.array([int(np.searchsorted(vocabulary, np.uint64(END)))], pa.int64()),
            pa.array([len(hashes)], pa.int64()),
        ],
        _names(_CHUNK),
    )


def word_hashes(text: str | None) -> np.ndarray:
    """Hashes of a text's words, lower-cased A-Z, and of its end."""
    words = (text or "").encode().lower().split()
    out = np.empty(len(words) + 1, np.uint64)
    out[:-1] = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    out[-1] = END
    return out


def _to_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    base, number = TaskContext.get().partitionId() << 32, 0
    keys, train, parts, n = [], [], [], 0
    for batch in batches:
        for part in slices(batch):
            for key, text, learns in zip(*(c.to_pylist() for c in part.columns)):
                keys.append(key)
                train.append(learns)
                parts.append(word_hashes(text))
                n += len(parts[-1])
                if n >= CHUNK_TOKENS:
                    yield _chunk_row(base + number, keys, train, parts)
                    keys, train, parts, n, number = [], [], [], 0, number + 1
    if keys:
        yield _chunk_row(base + number, keys, train, parts)


def _one_by_one(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Chunk rows, a few megabytes each, of which only one is a Python object at a time."""
    for batch in batches:
        for part in slices(batch, 1):
            yield part.to_pylist()[0]


def _arrays(column: pa.ChunkedArray, kind: type) -> list[np.ndarray]:
    """A binary column's values as they lie in the Arrow buffers, without copies; nulls are left out."""
    return [np.frombuffer(x.as_buffer(), kind) for x in column if x.is_valid]


def _token_weights(row: dict) -> np.ndarray:
    """1 for each token of a text that teaches, else 0."""
    ends = np.frombuffer(row["ends"], np.int64)
    return np.repeat(np.array(row["train"], np.int64), np.diff(ends, prepend=0))


def _pairs(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each token with the one before it, and of each token; a text starts after an end."""
    words = np.frombuffer(row["vocabulary"], np.uint64)[_ids(row)]
    before = np.concatenate((np.array([END], np.uint64), words[:-1]))
    return pair_hash(before, words), words


# --- Counting --------------------------------------------------------------------


def _send_words(bucket_bits: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _one_by_one(batches):
            vocabulary = np.frombuffer(row["vocabulary"], np.uint64)
            counts = np.bincount(_ids(row), weights=_token_weights(row), minlength=len(vocabulary)).astype(np.uint32)
            cuts = _cuts(_bucket(vocabulary, bucket_bits), 1 << bucket_bits)
            for b in np.flatnonzero(np.diff(cuts)).tolist():
                at = slice(int(cuts[b]), int(cuts[b + 1]))
                columns = [
                    pa.array([b], pa.int32()),
                    pa.array([row["chunk"]], pa.int64()),
                    pa.array([vocabulary[at].tobytes()]),
                    pa.array([counts[at].tobytes()]),
                ]
                yield pa.record_batch(columns, ["bucket", "chunk", "hashes", "counts"])

    return send


def _send_pairs(bucket_bits: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _one_by_one(batches):
            pairs = _pairs(row)[0][_token_weights(row) > 0]
            hashes, counts = np.unique(pairs, return_counts=True)
            short = _short(hashes, bucket_bits)
            cuts = _cuts(_bucket(hashes, bucket_bits), 1 << bucket_bits)
            for b in np.flatnonzero(np.diff(cuts)).tolist():
                at = slice(int(cuts[b]), int(cuts[b + 1]))
                packed = short[at].view(np.uint8).reshape(-1, 8)[:, :5].tobytes()
                many = np.flatnonzero(counts[at] > 1).astype(np.uint32)
                columns = [
                    pa.array([b], pa.int32()),
                    pa.array([packed]),
                    pa.array([many.tobytes()]),
                    pa.array([counts[at][many].astype(np.uint32).tobytes()]),
                ]
                yield pa.record_batch(columns, ["bucket", "hashes", "repeated", "counts"])

    return send


def _short(hashes: np.ndarray, bucket_bits: int) -> np.ndarray:
    """What of a pair's hash is kept: the 40 bits below the bucket's.

    Two pairs of a bucket share them once in a million, far less often than the
    filter takes an absent entry for one that it holds.
    """
    return (hashes << np.uint64(bucket_bits)) >> np.uint64(24)


def _total(hashes: list[np.ndarray], counts: list[np.ndarray]):
    distinct, inverse = np.unique(np.concatenate(hashes), return_inverse=True)
    return distinct, np.bincount(inverse, weights=np.concatenate(counts)).astype(np.int64), inverse


_COUNTED = "kind string, bucket int, chunk long, data binary, n long, total long"


def _counted(rows: list[tuple]) -> pa.Table:
    kinds = [pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
    names = ["kind", "bucket", "chunk", "data", "n", "total"]
    return pa.table([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def _merge_words(group: pa.Table) -> pa.Table:
    """A segment of the filter, and to each chunk the counts of the words it sent."""
    bucket = group["bucket"][0].as_py()
    hashes = _arrays(group["hashes"], np.uint64)
    counts = _arrays(group["counts"], np.uint32)
    distinct, totals, inverse = _total(hashes, counts)
    learned = totals > 0
    segment = build_segment(distinct[learned], totals[learned])
    rows = [("words", bucket, None, segment.tobytes(), int(learned.sum()), int(totals.sum()))]
    answers, at = totals[inverse], 0
    for chunk, sent in zip(group["chunk"].to_pylist(), hashes):
        rows.append(("counts", bucket, chunk, answers[at : at + len(sent)].tobytes(), None, None))
        at += len(sent)
    return _counted(rows)


def _merge_pairs(least: int):
    def merge(group: pa.Table) -> pa.Table:
        bucket, hashes, counts = group["bucket"][0].as_py(), [], []
        sent = (_arrays(group["hashes"], np.uint8), *(_arrays(group[c], np.uint32) for c in ("repeated", "counts")))
        for packed, repeated, many in zip(*sent):
            wide = np.zeros((len(packed) // 5, 8), np.uint8)
            wide[:, :5] = packed.reshape(-1, 5)
            hashes.append(wide.view(np.uint64).ravel())
            counts.append(np.ones(len(wide), np.int64))
            counts[-1][repeated] = many
        distinct, totals, _ = _total(hashes, counts)
        often = totals >= least
        segment = build_segment(distinct[often], totals[often], least)
        return _counted([("pairs", bucket, None, segment.tobytes(), int(often.sum()), int(totals.sum()))])

    return merge


# --- Probing and scoring ---------------------------------------------------------


def _slices_of(segments: DataFrame, limit: int) -> list[list[tuple[str, int]]]:
    """Segments in groups of at most `limit` bytes; one that is larger stands alone."""
    sizes = segments.select("kind", "bucket", F.octet_length("data").alias("size")).collect()
    out, room = [], 0
    for kind, bucket, size in sorted(sizes):
        if not out or size > room:
            out.append([])
            room = limit
        out[-1].append((kind, bucket))
        room -= size
    return out


def _probe(shared, bucket_bits: int):
    """Levels of the chunk's words and of its tokens' pairs, 0 where another slice has them."""

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _one_by_one(batches):
            words, pairs = np.frombuffer(row["vocabulary"], np.uint64), _pairs(row)[0]
            words = shared.value["words"].levels(words, _bucket(words, bucket_bits))
            pairs = shared.value["pairs"].levels(_short(pairs, bucket_bits), _bucket(pairs, bucket_bits))
            columns = [pa.array([row["chunk"]], pa.int64()), pa.array([words.tobytes()]), pa.array([pairs.tobytes()])]
            yield pa.record_batch(columns, ["chunk", "words", "pairs"])

    return probe


_SCORES = (
    "key long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def _score(total: int, distinct: int, prior: float, least: int):
    def score(group: pa.Table) -> pa.Table:
        row = group.filter(pc.is_valid(group["ids"])).to_pylist()[0]
        answers = group.filter(pc.is_valid(group["counts"])).sort_by("bucket")
        counts = np.concatenate(_arrays(answers["counts"], np.int64))
        words = reduce(np.maximum, _arrays(group["words"], np.uint8))
        pairs = reduce(np.maximum, _arrays(group["pairs"], np.uint8))
        ids = _ids(row)
        ends = np.frombuffer(row["ends"], np.int64)
        starts = ends - np.diff(ends, prepend=0)
        size = total + distinct + 1
        base = np.log10((counts + 1) / size)[ids]
        known = (counts > 0)[ids].astype(np.int64)
        # From here on the filter's counts alone.
        own = count_of(words.astype(np.int64))
        before = np.concatenate(([row["end_id"]], ids[:-1]))
        of_word = ((own + 1) / size)[ids]
        context = own[before]
        together = np.minimum(count_of(pairs.astype(np.int64), least), context)
        probability = (together + prior * of_word) / (context + prior)
        columns = [
            pa.array(row["keys"], pa.int64()),
            pa.array([not t for t in row["train"]], pa.bool_()),
            pa.array(ends - starts, pa.int64()),
            pa.array(np.add.reduceat(known, starts), pa.int64()),
            pa.array(np.full(len(ends), total), pa.int64()),
            pa.array(np.add.reduceat(base, starts), pa.float64()),
            pa.array(np.add.reduceat(np.log10(probability), starts), pa.float64()),
        ]
        return pa.table(columns, _names(_SCORES))

    return score


def _names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def score_texts(
    docs: DataFrame,
    learns_from: Column,
    key: str = "doc_id",
    text: str = "text",
    slice_bytes: int = SLICE_BYTES,
    min_pair_count: int = MIN_PAIR_COUNT,
    prior: float = PRIOR,
) -> DataFrame:
    """`(key, held_out, n_tokens, n_known, train_tokens, base_score, score)` of every row.

    The model learns words and pairs of words from rows where `learns_from` holds,
    a condition over `docs`; the others, and where it is null, are held out.
    `score` is the log10 probability of a text's words and its end, each given the
    word before: the pair's count against the word's, both from the filter, with
    `prior` times the word's own frequency. `base_score` takes exact word counts
    alone, plus one.

    A null or empty text has one token, its end. Rows with null or repeated keys
    are texts of their own. If nothing teaches, every count is 0. An empty table
    gives no row; columns that neither condition, key nor text name are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(key).cast("long").alias("key"),
        F.col(text).cast("string").alias("text"),
        F.coalesce(learns_from, F.lit(False)).alias("learns"),
    )
    with arrow_bytes(spark, ARROW_BYTES):
        chunks = stored(rows.mapInArrow(_to_chunks, _CHUNK))
    n_tokens = chunks.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    bucket_bits = max(0, min(20, int(np.ceil(np.log2(max(1, n_tokens) / BUCKET_ENTRIES)))))
    words = (
        chunks.select("chunk", "vocabulary", "ids", "ends", "train")
        .mapInArrow(_send_words(bucket_bits), "bucket int, chunk long, hashes binary, counts binary")
        .groupBy("bucket")
        .applyInArrow(_merge_words, _COUNTED)
    )
    pairs = (
        chunks.select("vocabulary", "ids", "ends", "train")
        .mapInArrow(_send_pairs(bucket_bits), "bucket int, hashes binary, repeated binary, counts binary")
        .groupBy("bucket")
        .applyInArrow(_merge_pairs(min_pair_count), _COUNTED)
    )
    with arrow_bytes(spark, ARROW_BYTES):
        counted = stored(words.unionByName(pairs))
    segments = counted.filter("kind IN ('words', 'pairs')")
    total, distinct = counted.filter("kind = 'words'").agg(
        F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))
    ).first()
    found = None
    for wanted in _slices_of(segments, slice_bytes) or [[]]:
        buckets = [b for _, b in wanted]
        near = segments.filter(F.col("bucket").isin(buckets)) if len(buckets) < 64 else segments
        chosen = set(wanted)
        held: dict[str, dict[int, bytes]] = {"words": {}, "pairs": {}}
        for kind, bucket, data in near.select("kind", "bucket", "data").toLocalIterator():
            if (kind, bucket) in chosen:
                held[kind][bucket] = bytes(data)
        shared = spark.sparkContext.broadcast({kind: Segments(1 << bucket_bits, x) for kind, x in held.items()})
        probed = chunks.select("chunk", "vocabulary", "ids", "ends").mapInArrow(
            _probe(shared, bucket_bits), "chunk long, words binary, pairs binary"
        )
        with arrow_bytes(spark, ARROW_BYTES):
            part = stored(probed)
        shared.unpersist()
        found = part if found is None else found.unionByName(part)
    answers = counted.filter("kind = 'counts'").select("chunk", "bucket", F.col("data").alias("counts"))
    everything = (
        chunks.drop("n_tokens", "vocabulary")
        .unionByName(answers, allowMissingColumns=True)
        .unionByName(found, allowMissingColumns=True)
    )
    return (
        everything.groupBy("chunk")
        .applyInArrow(_score(int(total), int(distinct), prior, min_pair_count), _SCORES)
        .withColumnRenamed("key", key)
    )
