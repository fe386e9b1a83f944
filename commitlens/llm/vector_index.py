"""Operator 6: nearest vectors by balanced posting lists.

Centroids are learned by splitting a bounded sample again and again into halves of
equal size, so lists are balanced. Every vector goes to its nearest list, and a
boundary vector also to others that are not much farther, unless a list it is in
already stands between. A query walks a graph of the centroids in memory, takes
the lists whose distance is within a ratio of that of its nearest few, and is
compared with every vector in them, in double precision. Neighbouring lists share
a cell, so that a query travels once per cell; its nearest cell is searched first,
and the others then only report what is no worse than what that one found.

The largest inner product is a smallest distance once each vector gets one more
coordinate that makes all equally long. Centroids are brought to that length too:
a mean is shorter than what it stands for, and between short means nothing would
ever lie near a boundary.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commitlens.scratch import stored

# Vectors that centroids are learned from, and their bytes; centroids, at most.
SAMPLE_ROWS = 65_536
SAMPLE_BYTES = 32 << 20
MAX_LISTS = 16_384
# Vectors a list has on average before replicas, and lists in a cell.
LIST_ROWS = 8
CELL_LISTS = 512
# Vectors, and queries, of a cell that one scan holds; what is more is dealt to several.
BLOCK_ROWS = 1 << 15
# Lists of a vector at most, and how much farther than the nearest they may be (squared).
REPLICAS = 4
BOUNDARY = 1.50
# Lists whose squared distance is within this ratio are searched: of the distance of that
# list which is this share of the root of their number away from the query, in rank.
PRUNE = 1.25
BASE_SHARE = 0.25
# Neighbours of a centroid in the graph, what a walk looks beyond its limit, and its stride.
DEGREE = 24
BEAM_SHARE = 1.05
STRIDE = 16
# Distances held at once.
BLOCK_DISTANCES = 1 << 20
_SEED = 11


# --- Centroids and their graph, on plain arrays ----------------------------------


def _parts_of(points: np.ndarray, rng: np.random.Generator, n: int) -> np.ndarray:
    """Two-means of fixed sizes: which points belong to the second, `n // 2` parts of `n`."""
    a, b = points[rng.choice(len(points), 2, replace=False)]
    cut = max(1, len(points) - len(points) * (n // 2) // n)
    for _ in range(6):
        lean = points @ (b - a)
        second = np.zeros(len(points), bool)
        second[np.argsort(lean, kind="stable")[min(cut, len(points) - 1) :]] = True
        a, b = points[~second].mean(axis=0), points[second].mean(axis=0)
    return second


def learn_centroids(sample: np.ndarray, lists: int, seed: int = _SEED) -> np.ndarray:
    """Means of `lists` parts of the sample of nearly equal size; neighbours stand together."""
    rng = np.random.default_rng(seed)

    def parts(points: np.ndarray, n: int) -> list[np.ndarray]:
        if n <= 1 or len(points) < 2:
            return [points.mean(axis=0)]
        second = _parts_of(points, rng, n)
        return parts(points[~second], n - n // 2) + parts(points[second], n // 2)

    return np.array(parts(sample, min(lists, len(sample))))


def of_length(vectors: np.ndarray, length: float) -> np.ndarray:
    norms = np.sqrt((vectors**2).sum(axis=1))[:, None]
    return vectors * (length / np.where(norms > 0, norms, 1))


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * a @ b.T
    return np.maximum(d, 0)


class CentroidGraph:
    """Each centroid's nearest neighbours and some far ones, walked best first."""

    def __init__(self, centroids: np.ndarray, degree: int = DEGREE, seed: int = _SEED):
        self.centroids, n = centroids, len(centroids)
        rng, near = np.random.default_rng(seed), []
        block = max(1, BLOCK_DISTANCES // max(1, n))
        for at in range(0, n, block):
            d = squared_distances(centroids[at : at + block], centroids)
            d[np.arange(len(d)), np.arange(at, at + len(d))] = np.inf
            k = min(degree, n - 1)
            near.append(np.argpartition(d, k - 1, axis=1)[:, :k] if k else np.zeros((len(d), 0), np.int64))
        near = np.concatenate(near) if near else np.zeros((0, 0), np.int64)
        linked = [set(row.tolist()) for row in near]
        for a, row in enumerate(near.tolist()):
            for b in row:
                linked[b].add(a)
        # A ring over a random order keeps the graph in one piece.
        ring = rng.permutation(n)
        for a, b in zip(ring.tolist(), np.roll(ring, 1).tolist()):
            if a != b:
                linked[a].add(b)
                linked[b].add(a)
        self.links = [np.fromiter(x, np.int64, len(x)) for x in linked]
        # Starting points, spread over the centroids.
        self.entries = ring[: max(1, int(np.sqrt(n)))]

    def within(
        self, query: np.ndarray, ratio: float, base: int = 1, sizes: np.ndarray | None = None, enough: int = 0
    ) -> np.ndarray:
        """Centroids within `ratio` times the squared distance of the `base`-th nearest, nearest first.

        Where the `sizes` of fewer lists than that add up to less than `enough`,
        the distance of the first that makes it enough takes its place. The walk
        goes on until the next candidates are clearly beyond.
        """
        seen = np.zeros(len(self.centroids), bool)
        open_nodes, open_d = np.zeros(0, np.int64), np.zeros(0)
        walked, walked_d, limit = np.zeros(0, np.int64), np.zeros(0), np.inf
        new = self.entries
        while True:
            seen[new] = True
            delta = self.centroids[new] - query
            open_nodes = np.concatenate((open_nodes, new))
            open_d = np.concatenate((open_d, np.einsum("ij,ij->i", delta, delta)))
            if not len(open_d) or open_d.min() > limit * BEAM_SHARE + 1e-12:
                break
            stride = min(STRIDE, len(open_d))
            order = np.argpartition(open_d, stride - 1)
            now, rest = order[:stride], order[stride:]
            walked, walked_d = np.concatenate((walked, open_nodes[now])), np.concatenate((walked_d, open_d[now]))
            order = np.argsort(walked_d, kind="stable")
            walked, walked_d = walked[order], walked_d[order]
            at = base - 1
            if sizes is not None:
                at = max(at, int(np.searchsorted(np.cumsum(sizes[walked]), enough)))
            limit = walked_d[at] * ratio if at < len(walked) else np.inf
            new = np.unique(np.concatenate([self.links[x] for x in open_nodes[now].tolist()]))
            new, open_nodes, open_d = new[~seen[new]], open_nodes[rest], open_d[rest]
        return walked[walked_d <= limit + 1e-12]


def lists_of(vectors: np.ndarray, centroids: np.ndarray) -> Iterator[list[int]]:
    """Lists of each vector: the nearest, and boundary lists that no nearer one covers."""
    k = min(REPLICAS * 4, len(centroids))
    block = max(1, BLOCK_DISTANCES // max(len(centroids), k * centroids.shape[1]))
    for at in range(0, len(vectors), block):
        d = squared_distances(vectors[at : at + block], centroids)
        near = np.argpartition(d, k - 1, axis=1)[:, :k]
        near = np.take_along_axis(near, np.argsort(np.take_along_axis(d, near, 1), axis=1, kind="stable"), 1)
        d = np.take_along_axis(d, near, 1)
        # Only a vector's own candidates are compared with each other.
        some = centroids[near]
        squares = (some * some).sum(axis=2)
        between = squares[:, :, None] + squares[:, None, :] - 2 * some @ some.transpose(0, 2, 1)
        for row, candidates, gaps in zip(d, near.tolist(), between):
            limit, taken = row[0] * BOUNDARY + 1e-12, []
            for c in range(k):
                if row[c] > limit or len(taken) == REPLICAS:
                    break
                if (gaps[c, taken] > row[c]).all():
                    taken.append(c)
            yield [candidates[c] for c in taken]


def augmented(vectors: np.ndarray, longest: float) -> np.ndarray:
    """One coordinate more, so that every vector has length `longest`."""
    rest = np.sqrt(np.maximum(longest**2 - (vectors**2).sum(axis=1), 0))
    return np.concatenate((vectors, rest[:, None]), axis=1)


# --- Over the table --------------------------------------------------------------


def _vectors(column: pa.Array | pa.ChunkedArray, kind: str) -> np.ndarray:
    """A column of packed numbers as rows of doubles."""
    return np.array([np.frombuffer(x, kind) for x in column.to_pylist()], np.float64)


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """`(id, v)`: keys, and vectors that are not null, zero or partly null or infinite."""
    v = F.col("v")
    kind = "array<float>" if dict(vectors.dtypes)[vector] == "array<float>" else "array<double>"
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast(kind).alias("v"))
    return rows.filter(F.col("id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes, with minus zero as zero, so that equal ones are equal bytes."""
    for batch in batches:
        if batch.num_rows:
            column = batch.column(1)
            flat, ends = column.flatten().to_numpy() + np.float32(0), np.cumsum(column.value_lengths().to_numpy())
            raw = [flat[a:b].tobytes() for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]
            yield pa.record_batch([batch.column(0), pa.array(raw, pa.binary())], ["id", "v"])


def _lengths(kind: str):
    """Largest component of each vector, and its length in units of that."""

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rows = _vectors(batch["v"], kind)
                peak = np.abs(rows).max(axis=1)
                units = np.sqrt(((rows / peak[:, None]) ** 2).sum(axis=1))
                columns = [batch["v"], batch["members"], pa.array(peak), pa.array(units)]
                yield pa.record_batch(columns, ["v", "members", "peak", "units"])

    return lengths


class _Best:
    """The best members per query so far, and a score that the k-th best cannot fall below."""

    def __init__(self, floor: np.ndarray, k: int, slack: np.ndarray):
        # Products of blocks differ in their last digits from those of single vectors.
        self.slack, self.k, self.found = slack, k, []
        self.floor = floor - slack

    def add(self, queries: np.ndarray, members: np.ndarray, scores: np.ndarray) -> None:
        # One more than k: the query itself may be among them.
        if scores.shape[1] > self.k:
            kth = np.partition(scores, scores.shape[1] - self.k - 1, axis=1)[:, scores.shape[1] - self.k - 1]
            self.floor[queries] = np.maximum(self.floor[queries], kth - self.slack[queries])
        row, column = np.nonzero(scores >= self.floor[queries][:, None])
        self.found.append((queries[row], members[column], scores[row, column]))

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each query's members at or above its floor, once each."""
        if not self.found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        query, member, score = (np.concatenate(x) for x in zip(*self.found))
        good = score >= self.floor[query]
        query, member, score = query[good], member[good], score[good]
        _, once = np.unique(query * (member.max(initial=0) + 1) + member, return_index=True)
        return query[once], member[once], score[once]


_FOUND = "query_id long, vec_id long, score double, compared long"


def _products(a: np.ndarray, b: np.ndarray, rows_a: np.ndarray, rows_b: np.ndarray) -> np.ndarray:
    """Inner products of pairs, the same whatever else is in the block; an undefined one is lowest."""
    out = np.zeros(len(rows_a))
    with np.errstate(over="ignore", invalid="ignore"):
        for at in range(0, len(out), 1 << 14):
            some = slice(at, at + (1 << 14))
            out[some] = (a[rows_a[some]] * b[rows_b[some]]).sum(axis=1)
    out[np.isnan(out)] = -np.inf
    return out


def _scan_cell(k: int, kind: str):
    def scan(group: pa.Table) -> pa.Table:
        is_query = group["is_query"].to_numpy(zero_copy_only=False)
        members, queries = group.filter(pa.array(~is_query)), group.filter(pa.array(is_query))
        out = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)]
        if members.num_rows and queries.num_rows:
            table, asked = _vectors(members["v"], kind), _vectors(queries["v"], kind)
            in_list, by_list = _positions(members["lists"]), _positions(queries["lists"])
            with np.errstate(over="ignore", invalid="ignore"):
                sums = np.abs(asked).sum(axis=1) * np.abs(table).max()
                slack = np.where(np.isfinite(sums), sums * 1e-13, 0)
                best = _Best(queries["floor"].to_numpy(), k, slack)
                for number, mine in in_list.items():
                    theirs = by_list.get(number, [])
                    for at in range(0, len(theirs), 512):
                        some = theirs[at : at + 512]
                        scores = asked[some] @ table[mine].T
                        scores[np.isnan(scores)] = -np.inf
                        best.add(some, mine, scores)
            query, member, _ = best.pairs()
            score = _products(asked, table, query, member)
            compared = queries["compared"].to_numpy()
            # All copies of a vector share its score; each has its own id.
            copies = members["members"].combine_chunks()
            ids, sizes = copies.flatten().to_numpy(), copies.value_lengths().to_numpy()
            first, many = np.cumsum(sizes) - sizes, sizes[member]
            at = np.repeat(first[member] - np.cumsum(many) + many, many) + np.arange(many.sum())
            compared, score = np.repeat(compared[query], many), np.repeat(score, many)
            query, vec_id = queries["id"].to_numpy()[np.repeat(query, many)], ids[at]
            order = np.lexsort((vec_id, -score, query))
            order = order[query[order] != vec_id[order]]
            query, vec_id, score, compared = query[order], vec_id[order], score[order], compared[order]
            rank = np.arange(len(query)) - np.searchsorted(query, query)
            out = [x[rank < k] for x in (query, vec_id, score, compared)]
        return pa.table(dict(zip(("query_id", "vec_id", "score", "compared"), map(pa.array, out))))

    return scan


def _positions(lists: pa.ChunkedArray) -> dict[int, np.ndarray]:
    """List number to the rows that name it."""
    column = lists.combine_chunks()
    numbers, rows = column.flatten().to_numpy(), np.repeat(np.arange(len(column)), column.value_lengths().to_numpy())
    order = np.argsort(numbers, kind="stable")
    numbers, rows = numbers[order], rows[order]
    cuts = np.flatnonzero(np.diff(numbers, prepend=-1))
    return {int(numbers[a]): rows[a:b] for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(numbers)])}


def _by_cell(found: list[np.ndarray]) -> tuple[np.ndarray, list[int], list[list[int]], list[bool]]:
    """For each row's lists, nearest first: row numbers, cells, the lists in each, is it the nearest's."""
    rows, cells, lists, nearest = [], [], [], []
    for row, numbers in enumerate(found):
        own: dict[int, list[int]] = {}
        for number in numbers:
            own.setdefault(int(number) // CELL_LISTS, []).append(int(number))
        for place, (cell, inside) in enumerate(own.items()):
            rows.append(row)
            cells.append(cell)
            lists.append(inside)
            nearest.append(place == 0)
    return np.array(rows, np.int64), cells, lists, nearest


_POSTED = "cell int, lists array<int>, v binary, members array<long>"
_ASKED = "cell int, lists array<int>, nearest boolean, v binary, id long, compared long"


def _index(distinct: DataFrame, size: int, list_rows: int, kind: str, width: int):
    """The centroid graph, the unit it measures in, and the length that all vectors are brought to.

    Measured in the largest component of all, no square overflows.
    """
    unit = distinct.agg(F.max("peak")).first()[0]
    longest = distinct.agg(F.max(F.col("peak") / unit * F.col("units"))).first()[0]
    rows = min(SAMPLE_ROWS, max(1, SAMPLE_BYTES // width))
    sample = distinct.select("v").orderBy(F.xxhash64("v"), "v").limit(rows).toArrow()
    lists = max(1, min(MAX_LISTS, size // list_rows, sample.num_rows))
    centroids = learn_centroids(augmented(_vectors(sample["v"], kind) / unit, longest), lists)
    return CentroidGraph(of_length(centroids, longest)), unit, longest


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    key: str = "vec_id",
    vector: str = "embedding",
    list_rows: int = LIST_ROWS,
    prune: float = PRUNE,
) -> DataFrame:
    """`(query_id, rank, vec_id, score, compared)`: the `k` largest inner products found per query.

    `is_query` is a condition on `id`, the key; every other row is a candidate.
    Ties go to the smaller key. Vectors that are null, zero, or hold a null or a
    number that is not finite take no part, nor do null keys, nor vectors of
    another length than most have (of lengths equally common, the shorter counts).
    A product too large for a double is infinite, one that is infinity less
    infinity counts as minus infinity. Rows that repeat a key are candidates
    each, and one query. An empty table gives no row.

    `compared` is the number of entries in the lists that a query searched; a
    vector is in `REPLICAS` lists at most. Lists are searched until they hold twice
    `k` others at least, or all are.

    Equal vectors are indexed once, with their `k` + 1 smallest keys, which is all
    an answer can hold. The index is an approximation: what no searched list
    holds is not found.
    """
    spark = vectors.sparkSession
    found = usable(vectors, key, vector)
    kind = "<f4" if dict(found.dtypes)["v"] == "array<float>" else "<f8"
    rows = stored(found.mapInArrow(_packed, "id long, v binary"))
    widths = rows.groupBy(F.octet_length("v").alias("width")).agg(F.count(F.lit(1)).alias("n"))
    most = widths.orderBy(F.desc("n"), "width").first()
    if most is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double, compared long")
    rows = rows.filter(F.octet_length("v") == most["width"])
    # A third of all vectors may be equal: only the first keys of each reach its group.
    copies = Window.partitionBy("v").orderBy("id")
    kept = rows.withColumn("n", F.row_number().over(copies)).filter(F.col("n") <= k + 1)
    distinct = kept.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("members"))
    distinct = stored(distinct.mapInArrow(_lengths(kind), "v binary, members array<long>, peak double, units double"))
    graph, unit, longest = _index(distinct, distinct.count(), list_rows, kind, most["width"])
    # At most `MAX_LISTS` centroids and their links.
    shared = spark.sparkContext.broadcast(graph)

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = list(lists_of(augmented(_vectors(batch["v"], kind) / unit, longest), shared.value.centroids))
                at, cells, lists, _ = _by_cell(found)
                part = batch.take(pa.array(at))
                columns = [pa.array(cells, pa.int32()), pa.array(lists, pa.list_(pa.int32())), part["v"], part["members"]]
                yield pa.record_batch(columns, ["cell", "lists", "v", "members"])

    posted = stored(distinct.select("v", "members").mapInArrow(post, _POSTED))
    # One number per list, `MAX_LISTS` at most.
    entries = posted.select(F.explode("lists").alias("list")).groupBy("list").agg(F.count(F.lit(1)).alias("n"))
    sizes = np.zeros(len(graph.centroids), np.int64)
    for number, n in entries.collect():
        sizes[number] = n
    base = max(1, round(BASE_SHARE * len(sizes) ** 0.5))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                asked = _vectors(batch["v"], kind)
                # A query's length does not change which vectors are nearest.
                asked = of_length(np.pad(asked / np.abs(asked).max(axis=1)[:, None], ((0, 0), (0, 1))), longest)
                # A vector stands in few lists: so many entries hold `k` others twice over.
                walks = [shared.value.within(q, prune, base, sizes, 2 * REPLICAS * (k + 1)) for q in asked]
                compared = np.array([sizes[w].sum() for w in walks])
                at, cells, lists, nearest = _by_cell(walks)
                part = batch.take(pa.array(at))
                columns = [pa.array(cells, pa.int32()), pa.array(lists, pa.list_(pa.int32())), pa.array(nearest)]
                columns += [part["v"], part["id"], pa.array(compared[at])]
                yield pa.record_batch(columns, ["cell", "lists", "nearest", "v", "id", "compared"])

    # A number given is kept: queries are few, but walks are long.
    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    queries = rows.filter(is_query).repartition(tasks, "id").dropDuplicates(["id"])
    asked = stored(queries.mapInArrow(ask, _ASKED))
    # Cells with more rows or queries than one scan holds are dealt out both ways.
    n_posted = posted.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    n_asked = asked.groupBy("cell").agg(F.count(F.lit(1)).alias("m"))
    cells = n_posted.join(n_asked, "cell").select(
        "cell",
        F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("blocks"),
        F.ceil(F.col("m") / BLOCK_ROWS).cast("int").alias("turns"),
    )
    cells = F.broadcast(stored(cells))
    members = posted.join(cells, "cell").select(
        "cell",
        F.pmod(F.xxhash64("v"), F.col("blocks")).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("turns") - 1)).alias("turn"),
        F.lit(False).alias("is_query"),
        "lists",
        "v",
        "members",
    )

    def scan(some: DataFrame) -> DataFrame:
        sent = some.join(cells, "cell").select(
            "cell",
            F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
            F.pmod(F.xxhash64("id"), F.col("turns")).cast("int").alias("turn"),
            F.lit(True).alias("is_query"),
            "lists",
            "v",
            "id",
            "floor",
            "compared",
        )
        both = members.unionByName(sent, allowMissingColumns=True)
        return both.groupBy("cell", "block", "turn").applyInArrow(_scan_cell(k, kind), _FOUND)

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    low = F.lit(float("-inf"))
    first = stored(scan(asked.filter("nearest").withColumn("floor", low)))
    # The k-th best of the nearest cell; cut once more where that was searched in blocks.
    ranked = first.withColumn("n", F.row_number().over(order)).filter(F.col("n") == k)
    floors = stored(ranked.select(F.col("query_id").alias("id"), F.col("score").alias("floor")))
    rest = asked.filter("NOT nearest").join(floors, "id", "left").withColumn("floor", F.coalesce("floor", low))
    return (
        first.unionByName(scan(rest))
        .dropDuplicates(["query_id", "vec_id"])
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score", "compared")
    )
