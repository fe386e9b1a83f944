"""Operator 11: similarity join on word shingles, with prefixes of token combinations.

A text's set is that of its distinct shingles, as 64-bit hashes. Two sets of at
least `percent` Jaccard similarity miss few of each other's tokens: at most
e = |x| - ceil(percent |x|) of a set x. So whatever part of x is long enough to
survive e losses must meet its partner there.

1. Tokens are ordered by how many sets have them, rarest first, and a set's prefix
   is extended until it survives any e losses. Tokens of one set alone index
   nothing, rare ones are indexed singly, frequent ones in combinations of two,
   very frequent ones of three. Combinations are made within subclasses only; a
   subclass with c tokens of a set survives c - k + 1 losses. Which of two prefixes
   ends first does not matter: the other holds all its own tokens up to there.
   All sets are counted, but only tokens with small hashes: a set has enough of
   them for a prefix. Where by chance it has not, more tokens follow by hash.
   Counting and indexing go by bands of set size, [2^b, 2^(b+1)); a set near the
   lower edge of its band stands in the band below as well.
2. Sets that share an entry meet in the group of the smallest set with that entry.
   Groups are verified with whole sets: sizes, then parity bitmaps whose distance
   never exceeds the sets' difference, then intersections; pairs already connected
   are passed over. Groups beyond a bound are dealt out in pairs of blocks.

Equal sets are one from step 2 on, so copies cost their reading only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commitlens.llm.components import connected_components
from commitlens.llm.tokens import slices
from commitlens.scratch import stored

# A token in at most about so many sets is indexed singly, in pairs, and beyond in triples.
SINGLES, PAIRS = 16, 1024
# Subclasses of a band, in hundredths of its smallest set, by combination length.
_SUBCLASS_PERCENT = {2: 4, 3: 3}
# Hundredths of all tokens that are counted, from band 5 on; all of them below.
_COUNTED_PERCENT = (60, 45, 38, 34, 30)
# Level of tokens that are not counted.
_UNCOUNTED = 255
# Prefix tokens, and sets, of a chunk.
CHUNK_TOKENS, CHUNK_SETS = 1 << 19, 1 << 16
# Distinct tokens that one counting group should have.
BUCKET_TOKENS = 1 << 19
# Tokens of the sets that one verifying task holds.
GROUP_TOKENS = 1 << 20
# Slots that tell which sets the second reading has to give back; two in one only cost shuffling.
_WANTED_SLOTS = 1 << 24
# Sets whose prefix a task has sent and so does not send again; a fresh start beyond.
_REMEMBERED = 1 << 17


# --- Sets, on plain arrays ---------------------------------------------------------


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9FB21C651E98DF25)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> np.uint64(32))


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    """Sorted hashes of a text's distinct shingles; of all its words if they are fewer, none without words."""
    words = (text or "").encode().lower().split()
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    if not words:
        return hashes
    length = min(shingle, len(words))
    n = len(words) - length + 1
    # Shorter sequences start from another value, so that none equals a whole shingle.
    out = np.full(n, length, np.uint64)
    for i in range(length):
        with np.errstate(over="ignore"):
            out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + n])
    return np.unique(out)


def signature(tokens: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(tokens.tobytes())


def losses(n: int, percent: int) -> int:
    """Most tokens that a set of `n` can miss of a partner."""
    return n * (100 - percent) // 100


def may_link(n: int, percent: int) -> bool:
    """Can a set of `n` tokens have a partner that differs from it?"""
    return n * (100 - percent) >= percent


def bands_of(n: int, percent: int) -> list[int]:
    """The set's band, and the one below if partners may lie there."""
    band = n.bit_length() - 1
    return [band, band - 1] if -(-percent * n // 100) < 1 << band else [band]


def subclasses(band: int, k: int) -> int:
    return max(1, (_SUBCLASS_PERCENT[k] << band) // 100)


def counted_below(band: int) -> int:
    """Tokens of a band are counted if their hashes are below this."""
    if band < 5:
        return 2**64 - 1
    return (_COUNTED_PERCENT[min(band - 5, len(_COUNTED_PERCENT) - 1)] << 64) // 100


def prefix_length(n: int, band: int, percent: int) -> int:
    """Tokens that survive any losses, whatever their classes are."""
    return min(n, losses(n, percent) + 1 + subclasses(band, 2) + 2 * subclasses(band, 3))


def unit_of(tokens: np.ndarray, band: int, percent: int) -> tuple[int, int]:
    """How many of a set's sorted tokens are counted, and how many its prefix is taken from."""
    counted = int(np.searchsorted(tokens, np.uint64(counted_below(band)), "right"))
    return counted, max(counted, prefix_length(len(tokens), band, percent))


def level_of(counts: np.ndarray | int) -> np.ndarray:
    """0 for tokens of one set, then eight levels for each doubling."""
    levels = 1 + np.floor(8 * np.log2(np.maximum(counts, 1))).astype(np.int64)
    return np.where(np.asarray(counts) < 2, 0, np.minimum(levels, _UNCOUNTED - 1)).astype(np.uint8)


def band_keys(tokens: np.ndarray, bands: np.ndarray | int) -> np.ndarray:
    """A token's key of 48 bits within a band; keys only find candidates."""
    with np.errstate(over="ignore"):
        return _mix(tokens + np.asarray(bands, np.uint64) * np.uint64(0xD1B54A32D192ED03)) >> np.uint64(16)


def _packed(keys: np.ndarray) -> bytes:
    return keys.view(np.uint16).reshape(-1, 4)[:, :3].tobytes()


def _unpacked(raw: np.ndarray) -> np.ndarray:
    out = np.zeros((len(raw) // 3, 4), np.uint16)
    out[:, :3] = raw.reshape(-1, 3)
    return out.view(np.uint64).ravel()


def _within_groups(groups: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """How many members of its group stand before each, in order of position."""
    order = np.lexsort((positions, groups))
    sorted_groups = groups[order]
    first = np.flatnonzero(np.diff(sorted_groups, prepend=-1))
    start = np.repeat(first, np.diff(np.append(first, len(order))))
    out = np.empty(len(order), np.int64)
    out[order] = np.arange(len(order)) - start
    return out


def _combined(parts: list[np.ndarray], k: int) -> np.ndarray:
    out = np.full(len(parts[0]), k, np.uint64)
    for part in parts:
        with np.errstate(over="ignore"):
            out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + part)
    return out


def entries_of(
    keys: np.ndarray, levels: np.ndarray, n: int, band: int, percent: int, singles: int, pairs: int
) -> np.ndarray:
    """Index entries of one set of `n` tokens; those that are not counted stand last."""
    rare_first = np.lexsort((keys, levels))
    if levels[rare_first[-1]] == _UNCOUNTED:
        # By hash, which is the order they come in.
        rare_first = np.argsort(np.where(levels == _UNCOUNTED, len(keys) + np.arange(len(keys)), np.argsort(rare_first)))
    keys, levels = keys[rare_first], levels[rare_first]
    classes = 1 + (levels > level_of(singles)).astype(np.int64) + (levels > level_of(pairs))
    classes[levels == 0] = 0
    classes[levels == _UNCOUNTED] = 1
    needed = losses(n, percent) + 1
    survives = np.ones(len(keys), np.int64)
    members: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for k in (2, 3):
        at = np.flatnonzero(classes == k)
        if len(at):
            groups = (keys[at] % np.uint64(subclasses(band, k))).astype(np.int64)
            survives[at] = _within_groups(groups, at) >= k - 1
            members[k] = (at, groups)
    cut = int(np.searchsorted(np.cumsum(survives), needed)) + 1
    out = [_combined([keys[:cut][classes[:cut] == 1]], 1)]
    for k, (at, groups) in members.items():
        inside = at < cut
        order = np.lexsort((at[inside], groups[inside]))
        own, group = keys[at[inside]][order], groups[inside][order]
        size = int(np.bincount(group).max(initial=0))
        for i in range(1, size):
            same = group[i:] == group[:-i]
            if k == 2:
                out.append(_combined([own[:-i][same], own[i:][same]], 2))
                continue
            for j in range(i + 1, size):
                both = group[j:] == group[:-j]
                out.append(_combined([own[:-j][both], own[i : len(own) - j + i][both], own[j:][both]], 3))
    return np.unique(np.concatenate(out))


# --- Reading -----------------------------------------------------------------------

_CHUNK = (
    "chunk long, keys array<long>, sizes array<long>, signatures binary, units binary, tokens binary, n_tokens long"
)


def _read(shingle: int, percent: int):
    """Chunks of rows: keys, set sizes and signatures, and tokens by units `(row, band, counted, length)`."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunk = TaskContext.get().partitionId() << 24
        seen: set[bytes] = set()
        keys, sizes, signatures, units, parts, n = [], [], [], [], [], 0

        def row() -> pa.RecordBatch:
            columns = [
                pa.array([chunk]),
                pa.array([keys], pa.list_(pa.int64())),
                pa.array([sizes], pa.list_(pa.int64())),
                pa.array([b"".join(signatures)]),
                pa.array([np.array(units, np.int64).tobytes()]),
                pa.array([b"".join(parts)]),
                pa.array([n]),
            ]
            return pa.record_batch(columns, _names(_CHUNK))

        for batch in batches:
            for part in slices(batch):
                for key, text in zip(*(c.to_pylist() for c in part.columns)):
                    tokens = shingle_set(text, shingle)
                    own, size = signature(tokens), len(tokens)
                    if own not in seen and may_link(size, percent):
                        if len(seen) >= _REMEMBERED:
                            seen.clear()
                        seen.add(own)
                        for band in bands_of(size, percent):
                            counted, length = unit_of(tokens, band, percent)
                            units.append((len(keys), band, counted, length))
                            parts.append(_packed(band_keys(tokens[:length], band)))
                            n += length
                    keys.append(key)
                    sizes.append(size)
                    signatures.append(own)
                    if n >= CHUNK_TOKENS or len(keys) >= CHUNK_SETS:
                        yield row()
                        chunk += 1
                        keys, sizes, signatures, units, parts, n = [], [], [], [], [], 0
        if keys:
            yield row()

    return read


def _names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def _one_by_one(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for part in slices(batch, 1):
            yield part.to_pylist()[0]


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per text again: `uid` is its place, chunk and row."""
    for row in _one_by_one(batches):
        n = len(row["keys"])
        columns = [
            pa.array(np.arange(n) + (row["chunk"] << 17)),
            pa.array(row["keys"], pa.int64()),
            pa.array(row["sizes"], pa.int64()),
            pa.array([row["signatures"][16 * i : 16 * i + 16] for i in range(n)], pa.binary()),
        ]
        yield pa.record_batch(columns, ["uid", "key", "n", "signature"])


# --- Counting ----------------------------------------------------------------------


def _chunk_keys(row: dict) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(row["units"], np.int64).reshape(-1, 4), _unpacked(np.frombuffer(row["tokens"], np.uint16))


def _cuts(sorted_keys: np.ndarray, bucket_bits: int) -> np.ndarray:
    buckets = (sorted_keys >> np.uint64(48 - bucket_bits)).astype(np.int64) if bucket_bits else np.zeros(len(sorted_keys), np.int64)
    return np.searchsorted(buckets, np.arange((1 << bucket_bits) + 1))


def _send(bucket_bits: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _one_by_one(batches):
            keys, counts = np.unique(_chunk_keys(row)[1], return_counts=True)
            cuts = _cuts(keys, bucket_bits)
            for b in np.flatnonzero(np.diff(cuts)).tolist():
                at = slice(int(cuts[b]), int(cuts[b + 1]))
                columns = [pa.array([b], pa.int32()), pa.array([row["chunk"]]), pa.array([_packed(keys[at])]),
                           pa.array([counts[at].astype(np.uint32).tobytes()])]
                yield pa.record_batch(columns, ["bucket", "chunk", "keys", "counts"])

    return send


def _arrays(column: pa.ChunkedArray, kind: type) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), kind) for x in column if x.is_valid]


def _count(group: pa.Table) -> pa.Table:
    """To each chunk the levels of the keys that it sent."""
    sent = [_unpacked(x) for x in _arrays(group["keys"], np.uint16)]
    distinct, inverse = np.unique(np.concatenate(sent), return_inverse=True)
    totals = np.bincount(inverse, weights=np.concatenate(_arrays(group["counts"], np.uint32)), minlength=len(distinct))
    ends = np.cumsum([len(x) for x in sent])
    answers = [x.tobytes() for x in np.split(level_of(totals)[inverse], ends[:-1])]
    columns = [group["chunk"].cast(pa.int64()), group["bucket"].cast(pa.int32()), pa.array(answers)]
    return pa.table(columns, ["chunk", "bucket", "levels"])


def _index(percent: int, singles: int, pairs: int):
    """Of one chunk and its answers: the entries of every set."""

    def index(group: pa.Table) -> pa.Table:
        row = group.filter(pc.is_valid(group["units"])).to_pylist()[0]
        answers = group.filter(pc.is_valid(group["levels"])).sort_by("bucket")
        units, keys = _chunk_keys(row)
        found, uids = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        if len(keys):
            # Buckets are ranges of keys, so their answers follow each other like the sorted keys.
            levels = np.concatenate(_arrays(answers["levels"], np.uint8))[np.unique(keys, return_inverse=True)[1]]
            ends = np.cumsum(units[:, 3])
            alone = np.add.reduceat(levels == 0, ends - units[:, 3], dtype=np.int64)
            for (at, band, counted, length), end, unshared in zip(units.tolist(), ends.tolist(), alone.tolist()):
                n = row["sizes"][at]
                # Enough tokens that nobody else has: there is no partner.
                if unshared > losses(n, percent):
                    continue
                own = levels[end - length : end].copy()
                own[counted:] = _UNCOUNTED
                entries = entries_of(keys[end - length : end], own, n, band, percent, singles, pairs)
                found.append(entries)
                uids.append(np.full(len(entries), (row["chunk"] << 17) + at))
        return pa.table([pa.array(np.concatenate(found).view(np.int64)), pa.array(np.concatenate(uids))], ["entry", "uid"])

    return index


# --- Verifying ---------------------------------------------------------------------


def _bitmaps(sets: list[np.ndarray], bits: int) -> np.ndarray:
    """Parity of the tokens on each of so many bits, as 64-bit words."""
    out = np.empty((len(sets), bits // 64), np.uint64)
    for row, tokens in zip(out, sets):
        odd = np.bincount((tokens % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
        row[:] = np.packbits(odd.astype(np.uint8)).view(np.uint64)
    return out


def _common(a: np.ndarray, b: np.ndarray) -> int:
    a, b = (a, b) if len(a) <= len(b) else (b, a)
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return int((b[at] == a).sum())


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    common = _common(a, b)
    return 100 * common >= percent * (len(a) + len(b) - common)


def linked(sets: list[np.ndarray], percent: int, sides: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that connect exactly what similar pairs connect; with `sides`, pairs of unequal sides only."""
    order = np.argsort([len(s) for s in sets], kind="stable")
    ordered = [sets[i] for i in order]
    sizes = np.array([len(s) for s in ordered])
    bits = max(256, 1 << int(np.median(sizes)).bit_length())
    maps = _bitmaps(ordered, bits)
    root, found = np.arange(len(sets)), []
    first = np.searchsorted(sizes * 100, sizes * percent)
    for i in range(1, len(sets)):
        others = np.arange(first[i], i)
        others = others[root[others] != root[i]]
        if sides is not None:
            others = others[sides[order[others]] != sides[order[i]]]
        if not len(others):
            continue
        # Similar sets differ in at most (100 - p) / (100 + p) of their sizes' sum.
        apart = np.bitwise_count(maps[others] ^ maps[i]).sum(axis=1, dtype=np.int64)
        near = np.flatnonzero(apart * (100 + percent) <= (sizes[others] + sizes[i]) * (100 - percent))
        for j in others[near[np.argsort(apart[near], kind="stable")]].tolist():
            if root[j] != root[i] and similar(ordered[i], ordered[j], percent):
                found.append((int(order[i]), int(order[j])))
                root[root == root[j]] = root[i]
    return found


def _verify(percent: int):
    def verify(group: pa.Table) -> pa.Table:
        group = group.sort_by([("centre", "ascending"), ("uid", "ascending")])
        centres, uids, blocks = (group[c].to_numpy() for c in ("centre", "uid", "block"))
        low, high = group["low"][0].as_py(), group["high"][0].as_py()
        sets = _arrays(group["tokens"], np.uint64)
        links = []
        starts = np.flatnonzero(np.diff(centres, prepend=centres[0] - 1))
        for begin, end in zip(starts.tolist(), [*starts[1:].tolist(), len(centres)]):
            sides = blocks[begin:end] if low != high else None
            links += [(uids[begin + i], uids[begin + j]) for i, j in linked(sets[begin:end], percent, sides)]
        columns = zip(*links) if links else ([], [])
        return pa.table([pa.array(np.array(c, np.int64)) for c in columns], ["a", "b"])

    return verify


def _wanted_words(wanted: DataFrame) -> np.ndarray:
    """A bitmap of fixed size over the signatures whose sets are needed, by their leading bits."""
    slot = F.conv(F.hex(F.substring("signature", 1, 3)), 16, 10).cast("long")
    bits = wanted.select(slot.alias("slot")).select(
        F.expr("slot div 64").cast("int").alias("word"), F.expr("shiftleft(1L, int(slot % 64))").alias("bit")
    )
    words = np.zeros(_WANTED_SLOTS // 64, np.int64)
    found = bits.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    words[found["word"].to_numpy()] = found["bits"].to_numpy()
    return words.view(np.uint64)


def _sets(docs: DataFrame, text: str, shingle: int, wanted: DataFrame) -> DataFrame:
    """`(uid, tokens)` of the sets that `wanted` names by signature, once each, read from the texts again."""
    words = docs.sparkSession.sparkContext.broadcast(_wanted_words(wanted))

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            for part in slices(batch):
                signatures, sets = [], []
                for value in part.column(0).to_pylist():
                    tokens = shingle_set(value, shingle)
                    own = signature(tokens)
                    slot = int.from_bytes(own[:3], "big")
                    if own in seen or not int(words.value[slot >> 6]) >> (slot & 63) & 1:
                        continue
                    if len(seen) >= _REMEMBERED:
                        seen.clear()
                    seen.add(own)
                    signatures.append(own)
                    sets.append(tokens.tobytes())
                if sets:
                    columns = [pa.array(signatures, pa.binary()), pa.array(sets, pa.binary())]
                    yield pa.record_batch(columns, ["signature", "tokens"])

    read = docs.select(F.col(text).cast("string")).mapInArrow(again, "signature binary, tokens binary")
    return read.join(wanted.select("signature", "uid"), "signature").groupBy("uid").agg(F.first("tokens").alias("tokens"))


def _members(stars: DataFrame) -> DataFrame:
    """`(centre, uid)` of each group, the centre among them."""
    return stars.unionByName(stars.select("centre", F.col("centre").alias("uid")).distinct())


def _verified(percent: int, stars: DataFrame, sizes: DataFrame, sets: DataFrame, group_tokens: int) -> DataFrame:
    """`(a, b)`: links within the groups."""
    members = stored(_members(stars).join(sizes, "uid"))
    groups = members.groupBy("centre").agg(F.sum("n").alias("all"))
    groups = stored(groups.withColumn("blocks", F.ceil(F.col("all") / group_tokens).cast("int")))
    total = groups.agg(F.sum(F.when(F.col("blocks") == 1, F.col("all")))).first()[0] or 0
    cells = max(1, -(-total // group_tokens))
    hot = F.col("blocks") > 1
    dealt = (
        members.join(groups.select("centre", "blocks"), "centre")
        .withColumn("block", F.pmod(F.xxhash64("uid"), "blocks").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "centre",
            "uid",
            "block",
            F.when(hot, F.col("centre")).otherwise(F.pmod(F.xxhash64("centre"), F.lit(cells))).alias("cell"),
            hot.alias("hot"),
            F.least("block", "other").alias("low"),
            F.greatest("block", "other").alias("high"),
        )
    )
    whole = dealt.join(sets, "uid")
    return whole.groupBy("hot", "cell", "low", "high").applyInArrow(_verify(percent), "a long, b long")


# --- The join ----------------------------------------------------------------------


def shingle_components(
    docs: DataFrame,
    shingle: int = 3,
    percent: int = 90,
    key: str = "doc_id",
    text: str = "text",
    singles: int = SINGLES,
    pairs: int = PAIRS,
    group_tokens: int = GROUP_TOKENS,
) -> DataFrame:
    """`(key, n_shingles, component)` of every row.

    Rows are linked whose sets of shingles, lower-cased A-Z, have `percent` (80 to
    100) hundredths or more of their union in common; `component` is the smallest
    key that links lead to, the row's own included. A text with fewer words is one
    shingle; one without words, or null, has an empty set, links with nothing and
    is its own component. A row with a null key links others but names no
    component, which is null if no row in it has a key. Repeated rows stay, as do
    rows that share a key. An empty table gives no row; columns other than key and
    text are not read. The other parameters decide how the work is done, never
    what comes out.
    """
    if not 80 <= percent <= 100:
        raise ValueError("the similarity must lie between 80 and 100 percent")
    source = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    chunks = stored(source.mapInArrow(_read(shingle, percent), _CHUNK))
    n_tokens = chunks.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    bucket_bits = max(0, min(20, int(np.ceil(np.log2(max(1, n_tokens) / BUCKET_TOKENS)))))
    prefixes = chunks.filter("n_tokens > 0").select("chunk", "sizes", "units", "tokens")
    answers = (
        prefixes.mapInArrow(_send(bucket_bits), "bucket int, chunk long, keys binary, counts binary")
        .groupBy("bucket")
        .applyInArrow(_count, "chunk long, bucket int, levels binary")
    )
    indexed = prefixes.unionByName(answers, allowMissingColumns=True)
    entries = stored(indexed.groupBy("chunk").applyInArrow(_index(percent, singles, pairs), "entry long, uid long"))
    rows = stored(chunks.select("chunk", "keys", "sizes", "signatures").mapInArrow(_rows_of, "uid long, key long, n long, signature binary"))
    # Equal sets are one; the first row that has one stands for it.
    firsts = stored(rows.filter("n > 0").groupBy("signature").agg(F.min("uid").alias("first")))
    centres = entries.groupBy("entry").agg(F.min("uid").alias("centre"), F.max("uid").alias("last"))
    met = entries.join(centres.filter("centre < last").drop("last"), "entry").filter("uid > centre")
    met = stored(met.select("centre", "uid").distinct())
    uids = met.select(F.col("centre").alias("uid")).unionByName(met.select("uid")).distinct()
    standing = stored(rows.join(uids, "uid").join(firsts, "signature").select("uid", "first", "signature", "n"))
    # A set's first row has all its entries, so a centre always is such a row.
    stars = met.join(standing.select("uid", "first"), "uid").select("centre", F.col("first").alias("uid"))
    stars = stored(stars.filter("centre <> uid").distinct())
    wanted = stored(standing.select(F.col("first").alias("uid"), "signature", "n").distinct())
    sets = _sets(docs, text, shingle, wanted)
    links = stored(_verified(percent, stars, wanted.select("uid", "n"), sets, group_tokens))
    roots = stored(connected_components(links)).withColumnRenamed("node", "first")
    named = firsts.join(roots, "first", "left").select("signature", F.coalesce("root", "first").alias("root"))
    least = rows.filter("n > 0").groupBy("signature").agg(F.min("key").alias("key"))
    rooted = stored(named.join(least, "signature"))
    smallest = rooted.groupBy("root").agg(F.min("key").alias("component"))
    components = stored(rooted.join(smallest, "root").select("signature", "component"))
    return rows.join(components, "signature", "left").select(
        F.col("key").alias(key),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("key")).alias("component"),
    )
