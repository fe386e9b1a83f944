"""The commits table on shared storage.

Every load writes its rows under a folder of its own:

    load=<id>/kind=commits/repo_id=<repository>/author_first_char=<letter>/*.parquet
    load=<id>/kind=rejects/repo_id=<repository>/...
    load=<id>/kind=rollups/repo_id=<repository>/...

and then publishes a pointer file that names, for each repository, the load that
holds it. Publishing is one rename of one small file: readers see the table before
a load or after it, never between, and no data moves. Pointers are numbered, and a
number is taken once. A load that finds its number taken looks at the table again
and goes on top of it, unless the other load replaced some of the same repositories.
So loads of different repositories may run at the same time.

Old pointers, and what they name, are kept for a while: readers that have begun
finish, and the table can be read as of an older pointer. Sweeping goes by age, also
for loads that were never published, so a load must end within that while.
"""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid
from collections import defaultdict
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commitlens.schema import COMMITS_SCHEMA, PARTITION_COLUMNS, REJECTS_TYPE, ROLLUP_SCHEMA
from commitlens.sources.files import delete, listed, names_in, read_text, rename, write_text

MAX_RECORDS_PER_FILE = 5_000_000
# A filter per row group, as large as its distinct values need and no larger than 1 MB.
_BLOOM_FILTERS = {
    "parquet.bloom.filter.enabled#commit_hash": "true",
    "parquet.bloom.filter.enabled#author": "true",
    "parquet.bloom.filter.adaptive.enabled": "true",
}
# Columns and patterns of rows that are packed for the exchange.
_PACKED = "__packed_"
_SHORT_HASH, _SHORT_BYTES, _ANY_HASH = "^[a-f0-9]{40}$", 20, "^(?:[a-f0-9]{40}|[a-f0-9]{64})$"
# How long what was replaced can still be read.
KEEP_SECONDS = 24 * 3600
POINTER, MAKING = "_pointer-", "_making-"
COMMITS, REJECTS, ROLLUPS = "commits", "rejects", "rollups"


def _partition(spark: SparkSession, column: str, value: str) -> str:
    utils = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return utils.getPartitionPathString(column, value)


class LoadConflict(RuntimeError):
    """Another load replaced some of the same repositories in the meantime; nothing was changed."""


def _numbers(names: list[str]) -> list[int]:
    return [int(n.removeprefix(POINTER)) for n in names if n.startswith(POINTER)]


class Pointer:
    """What a pointer file says.

    `commits`, `rejects` and `strays` map a repository's folder name to the load that
    holds its commits, its rejected blocks, and the stray lines kept with its
    commits; `rollups` the load that left a rollup of its commits. `written` counts
    the repositories of each load and kind.
    """

    def __init__(self, number: int = 0, said: dict | None = None):
        said = said or {}
        self.number = number
        self.commits: dict[str, str] = said.get("commits", {})
        self.rejects: dict[str, str] = said.get("rejects", {})
        self.strays: dict[str, str] = said.get("strays", {})
        self.rollups: dict[str, str] = said.get("rollups", {})
        self.written: dict[str, int] = said.get("written", {})

    @classmethod
    def read(cls, spark: SparkSession, root: str, version: int | None = None) -> Pointer:
        """The newest pointer, or that of a number; an empty one where nothing was ever published."""
        if version is None:
            version = max(_numbers(names_in(spark, root)), default=0)
        if version == 0:
            return cls()
        try:
            return cls(version, json.loads(read_text(spark, f"{root}/{POINTER}{version:012d}")))
        except Py4JJavaError as error:
            raise ValueError(f"version {version} of {root} is not kept") from error

    def publish(self, spark: SparkSession, root: str) -> None:
        said = {k: v for k, v in vars(self).items() if k != "number"}
        made = f"{root}/{MAKING}{uuid.uuid4().hex}"
        write_text(spark, made, json.dumps(said))
        rename(spark, made, f"{root}/{POINTER}{self.number + 1:012d}")

    def folders(self, root: str, kind: str, wanted: dict[str, str]) -> list[str]:
        """Folders of these repositories; a load's whole folder where all of it is wanted."""
        by_load = defaultdict(list)
        for repo, load in wanted.items():
            by_load[load].append(repo)
        out = []
        for load, repos in by_load.items():
            folder = f"{root}/load={load}/kind={kind}"
            whole = len(repos) == self.written.get(f"{load}/{kind}")
            out += [folder] if whole else [f"{folder}/{repo}" for repo in sorted(repos)]
        return out

    def used(self) -> set[str]:
        """Folders, below the root, that the table consists of."""
        found = {f"load={load}/kind={COMMITS}/{repo}" for repo, load in self.commits.items()}
        for kind, places in ((REJECTS, self.rejects), (ROLLUPS, self.rollups)):
            found |= {f"load={load}/kind={kind}/{repo}" for repo, load in places.items()}
        return found


def _read(spark: SparkSession, root: str, schema: T.StructType, folders: list[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).parquet(*folders).select(*schema.names)


def _chosen(spark: SparkSession, places: dict[str, str], repos: list[str] | None) -> dict[str, str]:
    if repos is None:
        return places
    names = [_partition(spark, "repo_id", repo) for repo in dict.fromkeys(repos)]
    return {name: places[name] for name in names if name in places}


def versions(spark: SparkSession, root: str) -> DataFrame:
    """`(version, published)`: the states of the table that are kept, the last is the present one."""
    found = [(_numbers([name])[0], at) for name, at in listed(spark, root).items() if name.startswith(POINTER)]
    rows = [(number, dt.datetime.fromtimestamp(at / 1000)) for number, at in sorted(found)]
    return spark.createDataFrame(rows, "version long, published timestamp")


def read_commits(
    spark: SparkSession, root: str, repos: list[str] | None = None, version: int | None = None
) -> DataFrame:
    """Scan the table; with `repos`, list and read those repositories' folders only.

    The schema is given, so keys that look like numbers stay text and an empty
    table reads as no rows. Repositories that are not there add no rows. With
    `version`, one of `versions`, the table is read as it was then.
    """
    pointer = Pointer.read(spark, root, version)
    places = _chosen(spark, pointer.commits, repos)
    commits = _read(spark, root, COMMITS_SCHEMA, pointer.folders(root, COMMITS, places))
    # An empty author's key is stored as the null partition.
    return commits.withColumn(
        "author_first_char", F.coalesce("author_first_char", F.lit(""))
    ).select(*COMMITS_SCHEMA.names)


def find_commits(spark: SparkSession, root: str, hashes: list[str], repos: list[str] | None = None) -> DataFrame:
    """Commits with one of these whole hashes.

    Row groups that cannot hold any are skipped by the Bloom filters that loads
    write; every file's footer is still read, so name the repositories if known.
    """
    wanted = list(dict.fromkeys(h.lower() for h in hashes))
    found = F.lit(False)
    # Equalities reach the filters in any number, a long list would not.
    for commit_hash in wanted:
        found = found | (F.col("commit_hash") == commit_hash)
    return read_commits(spark, root, repos).filter(found)


def read_rejects(spark: SparkSession, root: str, repos: list[str] | None = None) -> DataFrame:
    """`(repo_id, reason, text)` of each repository's last load, for those or for all.

    Blocks that were not ingested, and stray lines of those that were.
    """
    pointer = Pointer.read(spark, root)
    schema = T.StructType([T.StructField("repo_id", T.StringType()), T.StructField("rejects", REJECTS_TYPE)])
    parts = [
        _read(spark, root, schema, pointer.folders(root, kind, _chosen(spark, places, repos)))
        for kind, places in ((REJECTS, pointer.rejects), (COMMITS, pointer.strays))
    ]
    return parts[0].unionByName(parts[1]).filter("rejects IS NOT NULL").select("repo_id", F.inline("rejects"))


def read_stored_rollups(
    spark: SparkSession, root: str, repos: list[str] | None = None
) -> tuple[DataFrame, list[str]]:
    """Rollups that loads kept of the present commits, and the repositories without one."""
    pointer = Pointer.read(spark, root)
    places = _chosen(spark, pointer.commits, repos)
    kept = {repo: load for repo, load in places.items() if pointer.rollups.get(repo) == load}
    rows = _read(spark, root, ROLLUP_SCHEMA, pointer.folders(root, ROLLUPS, kept))
    return rows, [_name(spark, repo) for repo in sorted(places.keys() - kept.keys())]


def _name(spark: SparkSession, folder: str) -> str:
    """The repository that a folder is called after."""
    utils = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return utils.unescapePathName(folder.removeprefix("repo_id="))


def list_repos(spark: SparkSession, root: str) -> DataFrame:
    """The repositories in the table, from the pointer alone."""
    names = [_name(spark, folder) for folder in sorted(Pointer.read(spark, root).commits)]
    return spark.createDataFrame([(name,) for name in names], "repo_id string")


def _sweep(spark: SparkSession, root: str, keep_seconds: float) -> None:
    """Delete states of the table that were replaced so long ago, and loads that were never published."""
    found = listed(spark, root)
    limit = time.time() * 1000 - 1000 * keep_seconds
    numbers = sorted(_numbers(list(found)))
    # A pointer's time is over when the next one is published.
    over = {n: found[f"{POINTER}{following:012d}"] for n, following in zip(numbers, numbers[1:])}
    gone = [n for n in numbers if n in over and over[n] <= limit]
    used: set[str] = set()
    for number in numbers:
        if number not in gone:
            used |= Pointer.read(spark, root, number).used()
    loads = {place.split("/")[0] for place in used}
    # Pointers go last, so that a sweep that dies can be done again.
    for number in gone:
        for place in sorted(Pointer.read(spark, root, number).used() - used):
            if place.split("/")[0] in loads:
                delete(spark, f"{root}/{place}")
    for name, changed in found.items():
        unused = (name.startswith("load=") and name not in loads) or name.startswith(MAKING)
        if unused and changed <= limit:
            delete(spark, f"{root}/{name}")
    for number in gone:
        delete(spark, f"{root}/{POINTER}{number:012d}")


def _packed(rows: DataFrame) -> DataFrame:
    """File lists as one text, a line per file, and hashes as bytes, where they come back whole: half the bytes."""
    plain = F.forall(
        "files", lambda f: (F.length(f["status"]) == 1) & f["filename"].isNotNull() & ~f["filename"].contains("\n")
    )
    text = F.array_join(F.transform("files", lambda f: F.concat(f["status"], f["filename"])), "\n")
    ways = {
        "files": ((F.size("files") > 0) & plain, text),
        "parents": ((F.size("parents") > 0) & F.forall("parents", lambda p: p.rlike(_SHORT_HASH)), F.unhex(F.array_join("parents", ""))),
        "commit_hash": (F.col("commit_hash").rlike(_ANY_HASH), F.unhex("commit_hash")),
    }
    for column, (can, packed) in ways.items():
        can = F.coalesce(can, F.lit(False))
        rows = rows.withColumns({_PACKED + column: F.when(can, packed), column: F.when(~can, F.col(column))})
    return rows


def _unpacked(rows: DataFrame) -> DataFrame:
    text, parents, commit_hash = (F.col(_PACKED + c) for c in ("files", "parents", "commit_hash"))
    ways = {
        "files": F.transform(
            F.split(text, "\n"),
            lambda x: F.struct(F.substring(x, 1, 1).alias("status"), F.substr(x, F.lit(2)).alias("filename")),
        ),
        "parents": F.transform(
            F.sequence(F.lit(1), F.octet_length(parents), F.lit(_SHORT_BYTES)),
            lambda at: F.lower(F.hex(F.substr(parents, at, F.lit(_SHORT_BYTES)))),
        ),
        "commit_hash": F.lower(F.hex(commit_hash)),
    }
    whole = {c: F.when(F.col(_PACKED + c).isNotNull(), way).otherwise(F.col(c)) for c, way in ways.items()}
    return rows.withColumns(whole).drop(*(_PACKED + c for c in ways))


def _laid_out(rows: DataFrame) -> DataFrame:
    """One exchange: rows gather by partition folder, and a folder that is too
    large for one task is split (AQE rebalancing). Sorting by author lets a
    lookup skip row groups. Rows are shuffled and sorted packed."""
    folder = ["kind", *PARTITION_COLUMNS]
    return _unpacked(_packed(rows).hint("rebalance", *folder).sortWithinPartitions(*folder, "author"))


Rollup = Callable[[DataFrame], DataFrame]


def _keep_rollup(spark: SparkSession, folder: str, rollup: Rollup) -> None:
    """Work out the rollup of a load's commits and write it beside them."""
    commits = spark.read.schema(COMMITS_SCHEMA).parquet(f"{folder}/kind={COMMITS}")
    order = [c for c in ROLLUP_SCHEMA.names if c not in ("n", "sketch")]
    laid_out = rollup(commits).hint("rebalance", "repo_id").sortWithinPartitions(*order)
    laid_out.write.partitionBy("repo_id").parquet(f"{folder}/kind={ROLLUPS}")


def _merged(now: Pointer, name: str, found: dict[str, set[str]], emptied: set[str]) -> Pointer:
    """The table `now`, with what a load found in place of what was there."""
    after = Pointer(now.number)

    def replaced(places: dict[str, str], gone: set[str], own: set[str]) -> dict[str, str]:
        return {r: n for r, n in places.items() if r not in gone} | dict.fromkeys(own, name)

    seen = found[COMMITS] | found[REJECTS] | emptied
    after.commits = replaced(now.commits, emptied, found[COMMITS])
    after.rejects = replaced(now.rejects, seen, found[REJECTS])
    after.strays = replaced(now.strays, seen, found[COMMITS])
    after.rollups = replaced(now.rollups, found[COMMITS] | emptied, found[ROLLUPS])
    counts = now.written | {f"{name}/{kind}": len(repos) for kind, repos in found.items()}
    loads = {place.split("/")[0].removeprefix("load=") for place in after.used()}
    after.written = {key: n for key, n in counts.items() if key.split("/")[0] in loads}
    return after


def _publish(spark: SparkSession, root: str, before: Pointer, name: str, found: dict[str, set[str]], emptied: set[str]) -> None:
    """Publish on top of whatever is there, if no repository of this load has changed since `before`."""
    touched = found[COMMITS] | found[REJECTS] | emptied
    while True:
        now = Pointer.read(spark, root)
        for then, since in ((before.commits, now.commits), (before.rejects, now.rejects)):
            changed = sorted(r for r in touched if then.get(r) != since.get(r))
            if changed:
                delete(spark, f"{root}/load={name}")
                raise LoadConflict(f"{changed} were replaced by another load")
        try:
            return _merged(now, name, found, emptied).publish(spark, root)
        except FileExistsError:
            # The number was taken just now.
            continue


def load(
    spark: SparkSession,
    rows: DataFrame,
    root: str,
    repos: list[str] | None = None,
    rollup: Rollup | None = None,
    keep_seconds: float = KEEP_SECONDS,
) -> int:
    """Publish `rows` as the new content of their repositories; returns how many have commits.

    `rows` has the table's columns, `kind` (commits or rejects) and `rejects`. A
    repository with rejects only keeps its commits. With `repos`, exactly those
    are replaced, by nothing if they have no commits. With `rollup`, what it makes
    of the load's commits is kept beside them; it reads no other load's.

    A job that dies before it publishes leaves the table as it was. Loads of
    different repositories may run at once; of two that replace the same one the
    later to publish raises `LoadConflict` and changes nothing. What was replaced
    more than `keep_seconds` ago is deleted, and so are unpublished loads of that age.
    """
    before = Pointer.read(spark, root)
    _sweep(spark, root, keep_seconds)
    if repos is not None:
        rows = rows.filter(F.col("repo_id").isin(list(repos)))
    name = uuid.uuid4().hex
    folder = f"{root}/load={name}"
    (
        _laid_out(rows)
        .write.options(**_BLOOM_FILTERS)
        .partitionBy("kind", *PARTITION_COLUMNS)
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .option("compression", "zstd")
        .parquet(folder)
    )
    if rollup is not None and names_in(spark, f"{folder}/kind={COMMITS}"):
        _keep_rollup(spark, folder, rollup)
    found = {
        kind: {n for n in names_in(spark, f"{folder}/kind={kind}") if "=" in n} for kind in (COMMITS, REJECTS, ROLLUPS)
    }
    emptied = {_partition(spark, "repo_id", repo) for repo in repos or []} - found[COMMITS]
    _publish(spark, root, before, name, found, emptied)
    return len(found[COMMITS])


def replace_repos(
    spark: SparkSession,
    commits: DataFrame,
    root: str,
    repos: list[str] | None = None,
    rollup: Rollup | None = None,
    keep_seconds: float = KEEP_SECONDS,
) -> int:
    """Replace every repository that occurs in `commits`; returns how many.

    With `repos`, exactly those are replaced, by nothing if they have no rows.
    Their rejects go.
    """
    rows = commits.withColumn("kind", F.lit(COMMITS)).withColumn("rejects", F.lit(None).cast(REJECTS_TYPE))
    return load(spark, rows, root, repos, rollup, keep_seconds)


def replace_repo(
    spark: SparkSession, commits: DataFrame, root: str, repo_id: str, rollup: Rollup | None = None
) -> None:
    """Replace one repository by its rows in `commits`, which may be none."""
    replace_repos(spark, commits, root, [repo_id], rollup)
