"""Operator 1: token ids on disk, with a minimal perfect hash index per shard.

Texts are dealt to shards by key range and sorted; each shard is one data file of
raw ids, two or four bytes each, and one index file. The index holds no keys: a
minimal perfect hash sends a key to its slot, the slot's stored fingerprint tells
strangers apart, and the slot names the key's first row. A lookup is constant
time and reads the ids at a known offset.
"""

from __future__ import annotations

import io
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from commitlens.llm.shared_files import attempt_path, open_input, open_output
from commitlens.llm.rows import arrow_bytes
from commitlens.llm.tokens import encoder, slices
from commitlens.scratch import fresh_folder, stored

MAGIC = b"IDSHARD1"
# Bits per remaining key at each level of the hash.
GAMMA = 2
MAX_LEVELS = 64
# What one batch of texts to a worker may hold; a text is never cut.
_BATCH_BYTES = 4 << 20
# Standing in for a null key, which no lookup finds.
_NULL_KEY = np.iinfo(np.int64).min


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """64-bit finaliser of the keys under a seed."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & (2**64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys: one bit array per level.

    A key takes the first level at which it meets no other key; its slot is the
    number of set bits before it. About three bits a key.
    """

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.before = np.cumsum([0] + [int(bits.sum()) for bits in levels])
        self.ranks = [np.cumsum(bits, dtype=np.int64) - bits for bits in levels]

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels, rest = [], np.asarray(keys, np.int64)
        while len(rest):
            if len(levels) == MAX_LEVELS:
                raise ValueError("keys repeat")
            size = max(GAMMA * len(rest), 8)
            at = (_mix(rest, len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            rest = rest[~alone[at]]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """A slot per key, -1 for a key that no level holds; strangers may get one too."""
        keys = np.asarray(keys, np.int64)
        slot, open_ = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for number, bits in enumerate(self.levels):
            at = (_mix(keys[open_], number) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at]
            slot[open_[hit]] = self.before[number] + self.ranks[number][at[hit]]
            open_ = open_[~hit]
        return slot


class ShardIndex:
    """Index of one shard: key to its rows, row to its place among the ids.

    A lookup needs no keys; the list of them stands at the end, for scans alone.
    """

    def __init__(self, hash_: PerfectHash, fingerprints, first_row, n_rows, starts, keys, width: int):
        self.hash, self.fingerprints = hash_, fingerprints
        self.first_row, self.n_rows = first_row, n_rows
        self.starts, self.keys, self.width = starts, keys, width

    @classmethod
    def build(cls, keys: np.ndarray, lengths: np.ndarray, width: int) -> ShardIndex:
        """`keys` ascending, equal ones side by side; the null stand-in gets no slot."""
        starts = np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))
        distinct, first, count = np.unique(keys, return_index=True, return_counts=True)
        real = distinct != _NULL_KEY
        distinct, first, count = distinct[real], first[real], count[real]
        hash_ = PerfectHash.build(distinct)
        slot = hash_.slots(distinct)
        fingerprints = np.empty(len(distinct), "<u4")
        first_row, n_rows = np.empty(len(distinct), "<i8"), np.empty(len(distinct), "<i8")
        fingerprints[slot] = _mix(distinct, 99).astype(np.uint32)
        first_row[slot], n_rows[slot] = first, count
        return cls(hash_, fingerprints, first_row, n_rows, starts, keys, width)

    def lookup(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First row and number of rows per key; (-1, 0) where the shard lacks it."""
        keys = np.asarray(keys, np.int64)
        slot = self.hash.slots(keys)
        ok = slot >= 0
        ok[ok] = self.fingerprints[slot[ok]] == _mix(keys[ok], 99).astype(np.uint32)
        row, n = np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
        row[ok], n[ok] = self.first_row[slot[ok]], self.n_rows[slot[ok]]
        return row, n

    def to_bytes(self) -> bytes:
        arrays = [self.fingerprints, self.first_row, self.n_rows]
        arrays += [self.starts.astype("<i8"), self.keys.astype("<i8")]
        head = {
            "width": self.width,
            "levels": [len(bits) for bits in self.hash.levels],
            "keys": len(self.fingerprints),
            "rows": len(self.starts) - 1,
        }
        text = json.dumps(head).encode()
        out = io.BytesIO()
        out.write(MAGIC + len(text).to_bytes(4, "little") + text)
        for bits in self.hash.levels:
            out.write(np.packbits(bits).tobytes())
        for array in arrays:
            out.write(array.tobytes())
        return out.getvalue()

    @classmethod
    def from_bytes(cls, raw: bytes) -> ShardIndex:
        if raw[:8] != MAGIC:
            raise ValueError("not a shard index")
        end = 12 + int.from_bytes(raw[8:12], "little")
        head, at, levels = json.loads(raw[12:end]), end, []
        for size in head["levels"]:
            n = -(-size // 8)
            packed = np.frombuffer(raw, np.uint8, n, at)
            levels.append(np.unpackbits(packed, count=size).astype(bool))
            at += n
        arrays = []
        keys, rows = head["keys"], head["rows"]
        for kind, n in (("<u4", keys), ("<i8", keys), ("<i8", keys), ("<i8", rows + 1), ("<i8", rows)):
            arrays.append(np.frombuffer(raw, kind, n, at))
            at += arrays[-1].nbytes
        return cls(PerfectHash(levels), *arrays, head["width"])


def read_shard_index(uri: str) -> ShardIndex:
    with open_input(uri) as f:
        return ShardIndex.from_bytes(f.read())


def read_ids(f, index: ShardIndex, row: int) -> np.ndarray:
    """Ids of one row of an open data file: one seek, one read."""
    begin, end = int(index.starts[row]), int(index.starts[row + 1])
    f.seek(begin * index.width)
    return np.frombuffer(f.read((end - begin) * index.width), f"<u{index.width}").astype("<u4")


_MANIFEST = "shard int, low long, high long, n_rows long, n_tokens long, data string, index string"


def _write_shard(folder: str, tokenizer: str, end_id: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        encode = encoder(tokenizer)
        vocabulary = max(encode.tokenizer.get_vocab_size(with_added_tokens=True), end_id + 1)
        width = 2 if vocabulary <= 1 << 16 else 4
        keys, lengths, out = [], [], None
        data = attempt_path(folder, f"shard-{shard:06d}", ".ids")
        for batch in batches:
            for part in slices(batch):
                out = out or open_output(data)
                for ids in encode.encode(part.column(1).to_pylist()):
                    ids = np.append(np.frombuffer(ids, "<u4"), np.uint32(end_id))
                    out.write(ids.astype(f"<u{width}").tobytes())
                    lengths.append(len(ids))
                keys.append(part.column(0).fill_null(int(_NULL_KEY)).to_numpy(zero_copy_only=False))
        if out is None:
            return
        out.close()
        keys, lengths = np.concatenate(keys), np.array(lengths, np.int64)
        index = ShardIndex.build(keys, lengths, width)
        with open_output(path := data.removesuffix(".ids") + ".mph") as f:
            f.write(index.to_bytes())
        known = keys[keys != _NULL_KEY]
        low, high = (int(known[0]), int(known[-1])) if len(known) else (None, None)
        row = [shard, low, high, len(keys), int(lengths.sum()), data, path]
        names = ["shard", "low", "high", "n_rows", "n_tokens", "data", "index"]
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        yield pa.record_batch([pa.array([v], k) for v, k in zip(row, kinds)], names)

    return write


def write_token_store(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    key: str = "doc_id",
    text: str = "text",
    shards: int | None = None,
) -> DataFrame:
    """Write ids of every whole text, `end_id` after each, in ascending key order.

    Returns the manifest, one row per shard: `shard`, key range `low`..`high`,
    `n_rows`, `n_tokens`, paths `data` and `index`, and `start`, the ids of all
    shards before it. Shards follow the key order.

    A null text is empty and holds the end id alone. Rows with a null key come
    first and are stored, but not found by key. Rows that repeat a key are all
    stored, side by side, in order of their text's hash; a key repeated very
    often may span shards. An empty table has an empty manifest. Other columns
    are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    spread = ["key", F.xxhash64("text")]
    count = shards or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    write = _write_shard(fresh_folder(spark), tokenizer, end_id)
    with arrow_bytes(spark, _BATCH_BYTES):
        written = stored(
            rows.repartitionByRange(count, *spread)
            .sortWithinPartitions(*spread, "text")
            .mapInArrow(write, _MANIFEST)
        )
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return written.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


_ROWS = "key long, start long, n_tokens long, ids_crc32 long"
# Rows read at once in a scan.
_AT_ONCE = 2048


def _batch(key, start, n_tokens, crc) -> pa.RecordBatch:
    key = np.asarray(key, np.int64)
    columns = [pa.array(key, pa.int64(), mask=key == _NULL_KEY)]
    columns += [pa.array(c, pa.int64()) for c in (start, n_tokens, crc)]
    return pa.record_batch(columns, ["key", "start", "n_tokens", "ids_crc32"])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for shard in batch.to_pylist():
            index, base = read_shard_index(shard["index"]), shard["start"]
            # Each key is sought as a stranger would seek it; repeats follow their first.
            row, _ = index.lookup(index.keys)
            places = np.arange(len(index.keys))
            row = np.where(row < 0, places, row + places - np.searchsorted(index.keys, index.keys))
            with open_input(shard["data"]) as f:
                for at in range(0, len(row), _AT_ONCE):
                    rows = row[at : at + _AT_ONCE]
                    found = [read_ids(f, index, r) for r in rows.tolist()]
                    yield _batch(
                        index.keys[at : at + _AT_ONCE],
                        base + index.starts[rows],
                        [len(ids) for ids in found],
                        [zlib.crc32(ids) for ids in found],
                    )


def scan_token_store(manifest: DataFrame, key: str = "doc_id") -> DataFrame:
    """`(key, start, n_tokens, ids_crc32)` of every stored row, read back from the files.

    `start` counts the ids of all rows before it, `ids_crc32` is over the ids as
    little-endian unsigned 32-bit integers. One task reads whole shards.
    """
    files = manifest.select("data", "index", "start")
    tasks = max(1, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return files.repartition(tasks).mapInArrow(_scan, _ROWS).withColumnRenamed("key", key)


def look_up(manifest: DataFrame, keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """The same columns for the rows of the asked keys only, each by its index.

    The list of shards goes to every task; its size is the number of files. A
    shard's index is loaded once for all keys that a task seeks in it. Keys that
    are null or not stored give no row; one that is asked twice is answered once.
    """
    shards = manifest.select("low", "high", "data", "index", "start").filter("low IS NOT NULL")
    ranges = sorted(tuple(r) for r in shards.collect())
    asked = keys.select(F.col(key).cast("long").alias("key")).filter("key IS NOT NULL").distinct()

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = (np.array([r[i] for r in ranges], np.int64) for i in (0, 1))
        loaded: dict[str, ShardIndex] = {}
        for batch in batches:
            sought = batch.column(0).to_numpy()
            first, last = np.searchsorted(high, sought), np.searchsorted(low, sought, "right")
            for at in range(int(first.min(initial=0)), int(last.max(initial=0))):
                here = sought[(first <= at) & (at < last)]
                if not len(here):
                    continue
                _, _, data, path, base = ranges[at]
                if path not in loaded:
                    loaded = {path: read_shard_index(path)}
                index, out = loaded[path], ([], [], [], [])
                with open_input(data) as f:
                    for k, row, n in zip(here.tolist(), *(x.tolist() for x in index.lookup(here))):
                        for r in range(row, row + n):
                            ids = read_ids(f, index, r)
                            for c, v in zip(out, (k, base + int(index.starts[r]), len(ids), zlib.crc32(ids))):
                                c.append(v)
                if out[0]:
                    yield _batch(*out)

    return asked.repartitionByRange("key").mapInArrow(answer, _ROWS).withColumnRenamed("key", key)
