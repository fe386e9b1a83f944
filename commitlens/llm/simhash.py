"""Operator 7: near duplicates by SimHash, found by meeting in the middle.

Two fingerprints that differ in at most d bits share a variant: one that lies
within half of d of both. Every distinct fingerprint emits all its variants; equal
variants meet, and their fingerprints are linked to the smallest among them, which
is never farther than d. So a dense group gives a star per variant, not all pairs.

Variants need not travel. They are dealt out by their leading bits: a fingerprint
goes once to each bucket that any of its variants falls into, and the bucket's
task makes just those variants. A bucket with too many of them is dealt out
further by a linear code of the other bits, which spreads even a tight group.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from commitlens.llm.components import connected_components
from commitlens.llm.rows import unused_name
from commitlens.llm.tokens import slices
from commitlens.scratch import stored

# Variants a bucket should have on average, and has at most before it is dealt out further.
MEAN_VARIANTS = 1 << 20
MOST_VARIANTS = 1 << 23
# Numbers the linear code of each bit.
_CODE_SEED = 7


def fingerprint(text: str | None, shingle: int = 4, seed: int = 42) -> int:
    """SimHash of a whole text's word shingles; 0 for a text without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined, n = b" ".join(words), max(1, len(words) - shingle + 1)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    stops = ends[min(shingle, len(words)) - 1 :].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        part = zip(starts[at : at + (1 << 16)], stops[at : at + (1 << 16)])
        hashes = np.array([digest(joined[a:b], seed) for a, b in part], ">u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.asarray(values, np.uint64).view(np.int64), pa.int64())


def fingerprints(docs: DataFrame, key: str, text: str, shingle: int, also: str | None = None) -> DataFrame:
    """`(key, hash, fp)`: `also` as it is, a long, and the fingerprint as a signed long."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = np.array([fingerprint(t, shingle) for t in part.column(2).to_pylist()], np.uint64)
                yield pa.record_batch([part.column(0), part.column(1), _signed(found)], ["key", "hash", "fp"])

    extra = F.col(also) if also else F.lit(None)
    rows = docs.select(
        F.col(key).cast("long").alias("key"), extra.cast("long").alias("hash"), F.col(text).cast("string").alias("text")
    )
    return rows.mapInArrow(of, "key long, hash long, fp long")


# --- Variants of fingerprints, on plain arrays -----------------------------------


@cache
def _masks(bits: int, most: int) -> np.ndarray:
    """Every mask of at most `most` of the low `bits` bits, fewest first."""
    ones = [np.uint64(1 << i) for i in range(bits)]
    out = [sum(map(int, c)) for k in range(most + 1) for c in combinations(ones, k)]
    return np.array(out, np.uint64)


@cache
def _code(values_bits: int, code_bits: int) -> np.ndarray:
    """A code word per bit; a value's word is the xor of those of its bits."""
    return np.random.default_rng(_CODE_SEED).integers(0, 1 << code_bits, values_bits, np.int64)


def _word(values: np.ndarray, low_bits: int, code_bits: int) -> np.ndarray:
    out, code = np.zeros(len(values), np.int64), _code(low_bits, code_bits)
    for i in range(low_bits):
        out ^= code[i] * ((values >> np.uint64(i)) & np.uint64(1)).astype(np.int64)
    return out


def _prefix(fps: np.ndarray, bits: int) -> np.ndarray:
    return fps >> np.uint64(64 - bits) if bits else np.zeros(len(fps), np.uint64)


def _destinations(fps: np.ndarray, bits: int, radius: int):
    """`(fingerprints' bucket, variants each makes there)` for each flip of leading bits."""
    prefix = _prefix(fps, bits)
    for flip in _masks(bits, radius):
        rest = radius - int(flip).bit_count()
        yield prefix ^ flip, len(_masks(64 - bits, rest))


def _variants(fps: np.ndarray, bucket: int, bits: int, radius: int, part: int, code_bits: int):
    """`(variants, owners)` that fall into one part of one bucket; owners index `fps`."""
    low = 64 - bits
    flips = np.bitwise_count(_prefix(fps, bits) ^ np.uint64(bucket))
    base = fps & np.uint64((1 << low) - 1)
    for used in range(radius + 1):
        here = np.flatnonzero(flips == used)
        masks = _masks(low, radius - used)
        if not code_bits:
            yield (base[here, None] ^ masks).ravel(), np.repeat(here, len(masks))
            continue
        # Only masks whose word leads from the fingerprint's word to this part.
        words, of_mask = _word(base[here], low, code_bits), _word(masks, low, code_bits)
        for word in np.unique(words).tolist():
            mine, fitting = here[words == word], masks[of_mask == word ^ part]
            yield (base[mine, None] ^ fitting).ravel(), np.repeat(mine, len(fitting))


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index of each of `n` nodes' component under links a-b."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _links_of_bucket(fps: np.ndarray, bucket: int, bits: int, distance: int, part: int, code_bits: int):
    """Links between fingerprints that share a variant here, one per member of each group."""
    near, far = distance // 2, distance - distance // 2
    fps = np.unique(fps)
    made = list(_variants(fps, bucket, bits, far, part, code_bits))
    variants = np.concatenate([v for v, _ in made])
    owners = np.concatenate([o for _, o in made])
    ordered = np.sort(variants)
    shared = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(shared):
        return fps[:0], fps[:0]
    at = np.minimum(np.searchsorted(shared, variants), len(shared) - 1)
    hit = np.flatnonzero(shared[at] == variants)
    at, owners = at[hit], owners[hit]
    # The smallest within the smaller radius; with it no link is longer than `distance`.
    full = shared | np.uint64(bucket << (64 - bits) if bits else 0)
    close = np.bitwise_count(fps[owners] ^ full[at]) <= near
    centre = np.full(len(shared), len(fps), np.int64)
    np.minimum.at(centre, at[close], owners[close])
    ok = centre[at] < len(fps)
    a, b = centre[at[ok]], owners[ok]
    verified = np.bitwise_count(fps[a] ^ fps[b]) <= distance
    root = _roots(len(fps), a[verified], b[verified])
    moved = np.flatnonzero(root != np.arange(len(fps)))
    return fps[root[moved]], fps[moved]


# --- The shuffle -----------------------------------------------------------------


def _leading_bits(n: int, radius: int) -> int:
    wanted = n * len(_masks(64, radius)) / MEAN_VARIANTS
    return min(24, max(0, int(np.ceil(np.log2(max(1.0, wanted))))))


def _unsigned(batch: pa.RecordBatch, column: str) -> np.ndarray:
    return batch.column(column).to_numpy().view(np.uint64)


def _hot_buckets(fps: DataFrame, bits: int, radius: int, most: int) -> dict[int, int]:
    """Code bits of each bucket that makes more than `most` variants.

    As many at most as all variants hold `most`.
    """

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << bits, np.int64)
        for batch in batches:
            for buckets, each in _destinations(_unsigned(batch, "fp"), bits, radius):
                np.add.at(total, buckets.astype(np.int64), each)
        used = np.flatnonzero(total)
        yield pa.record_batch([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    loads = fps.mapInArrow(load, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    return {b: int(np.ceil(np.log2(n / most))) for b, n in loads.filter(F.col("n") > most).collect()}


def find_links(
    spark: SparkSession, fps: DataFrame, distance: int, most_variants: int = MOST_VARIANTS
) -> DataFrame:
    """`(a, b)`: pairs that connect exactly what chains of links within `distance` connect.

    A bucket's task gives one pair for each member of a group but its smallest, to
    that smallest: the links between them are all verified, and most need not
    leave the task. `fps` holds distinct fingerprints `fp` as longs and should be stored.
    """
    radius = distance - distance // 2
    bits = _leading_bits(fps.count(), radius)
    hot = spark.sparkContext.broadcast(_hot_buckets(fps, bits, radius, most_variants))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _unsigned(batch, "fp")
            buckets = np.concatenate([b for b, _ in _destinations(found, bits, radius)])
            copies = np.tile(found, len(buckets) // max(1, len(found)))
            order = np.argsort(buckets, kind="stable")
            buckets, copies = buckets[order].astype(np.int64), copies[order]
            cuts = np.flatnonzero(np.diff(buckets, prepend=-1))
            rows = []
            for begin, end in zip(cuts.tolist(), [*cuts[1:].tolist(), len(buckets)]):
                bucket, packed = int(buckets[begin]), copies[begin:end].tobytes()
                rows.extend((bucket, part, packed) for part in range(1 << hot.value.get(bucket, 0)))
            if rows:
                kinds = [pa.int64(), pa.int32(), pa.binary()]
                columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
                yield pa.record_batch(columns, ["bucket", "part", "fps"])

    def meet(group: pa.Table) -> pa.Table:
        bucket, part = group["bucket"][0].as_py(), group["part"][0].as_py()
        found = np.frombuffer(b"".join(group["fps"].to_pylist()), np.uint64)
        a, b = _links_of_bucket(found, bucket, bits, distance, part, hot.value.get(bucket, 0))
        return pa.table({"a": _signed(a), "b": _signed(b)})

    sent = fps.mapInArrow(send, "bucket long, part int, fps binary")
    return sent.groupBy("bucket", "part").applyInArrow(meet, "a long, b long")


def _roots_of(rows: DataFrame, distance: int, most_variants: int) -> DataFrame:
    """`(fp, root)` of each distinct fingerprint in `rows`; the root is the smallest of its component."""
    distinct = stored(rows.select("fp").distinct())
    links = stored(find_links(rows.sparkSession, distinct, distance, most_variants))
    roots = stored(connected_components(links)).withColumnRenamed("node", "fp")
    return distinct.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def simhash_groups(
    docs: DataFrame,
    shingle: int = 4,
    distance: int = 4,
    key: str = "doc_id",
    text: str = "text",
    most_variants: int = MOST_VARIANTS,
) -> DataFrame:
    """`(key, fp, component)` of every row; `fp` is the fingerprint as a signed long.

    Rows whose fingerprints differ in at most `distance` bits are linked, and
    `component` is the smallest key that links lead to, a row's own included. Rows
    without words have fingerprint 0 and are linked like any other, nulls and
    empty texts alike. A row with a null key links others but names no component,
    which is null if no row in it has a key. Repeated rows stay. An empty table
    gives no row; columns other than key and text are not read.
    """
    rows = stored(fingerprints(docs, key, text, shingle))
    named = stored(_roots_of(rows, distance, most_variants))
    first = stored(rows.groupBy("fp").agg(F.min("key").alias("first")))
    named = named.join(first, "fp")
    smallest = stored(named.groupBy("root").agg(F.min("first").alias("component")))
    components = stored(named.join(smallest, "root").select("fp", "component"))
    return rows.join(components, "fp").select(F.col("key").alias(key), "fp", "component")


def keep_one_of_each(
    docs: DataFrame,
    shingle: int = 4,
    distance: int = 4,
    key: str = "doc_id",
    text: str = "text",
    most_variants: int = MOST_VARIANTS,
) -> DataFrame:
    """One row of `docs` for each group of near duplicates, columns unchanged.

    That with the smallest key stays, before any with a null key; among equal keys
    the text with the smallest hash. Of rows that repeat both, one stays.
    """
    hashed = F.xxhash64(F.col(text).cast("string"))
    light = fingerprints(docs.withColumn(hash_ := unused_name(docs, "__hash"), hashed), key, text, shingle, hash_)
    light = stored(light)
    named = stored(_roots_of(light, distance, most_variants))
    best = F.min(F.struct(F.col("key").isNull().alias("none"), "key", "hash")).alias("b")
    keepers = stored(light.join(named, "fp").groupBy("root").agg(best).select("b.key", "b.hash"))
    rows = docs.withColumn(hash_, hashed)
    same = rows[key].cast("long").eqNullSafe(keepers["key"]) & rows[hash_].eqNullSafe(keepers["hash"])
    number = unused_name(docs, "__number")
    along = Window.partitionBy(F.col(key), hash_).orderBy(hash_)
    kept = rows.join(keepers, same, "left_semi").withColumn(number, F.row_number().over(along))
    return kept.filter(F.col(number) == 1).select(*(kept[c] for c in docs.columns))
