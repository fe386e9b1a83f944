"""Commit blocks to commit rows, in built-in column expressions only."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commitlens.functions.text import after, strip
from commitlens.schema import COMMITS_SCHEMA, REJECTS_TYPE

# What a log's lines look like.
HASH = r"^(?:[a-f0-9]{40}|[a-f0-9]{64})$"
FILE_LINE = r"^[A-Z][0-9]*\t"
COMMIT, PARENTS, MESSAGE, AUTHOR, DATE = "commit: ", "parents:", "message:", "author:", "date:"
DATED = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2} [+-](?:[01][0-9]|2[0-3])[0-5][0-9]$"


def _lines(block: Column) -> Column:
    """Non-blank lines; a carriage return inside a subject also ends a line."""
    returns = F.replace(block, F.lit("\r"), F.lit("\n"))
    text = F.when(block.contains("\r"), returns).otherwise(block)
    return F.array_remove(F.split(text, "\n"), "")


def _author_index(lines: Column) -> Column:
    """0-based position of the author line; 3 unless the subject spans lines."""
    usual = F.get(lines, F.lit(3)).startswith(AUTHOR)
    before = F.substring_index(F.array_join(lines, "\n"), f"\n{AUTHOR}", 1)
    return F.when(usual, F.lit(3)).otherwise(F.greatest(F.size(F.split(before, "\n")), F.lit(3)))


def _is_file_line(line: Column) -> Column:
    """A status letter, perhaps a score, a tab; most lines show it in two characters."""
    plain = (F.substring(line, 2, 1) == "\t") & F.substring(line, 1, 1).between("A", "Z")
    return plain | (line.contains("\t") & line.rlike(FILE_LINE))


def _first_hash(line: Column) -> Column:
    return F.when(line.startswith(COMMIT), F.substr(line, F.lit(len(COMMIT) + 1))).otherwise(line)


def _instant(dated: Column) -> Column:
    """Local time less its offset, which may be any below 24 hours; null if either is malformed."""
    hours, minutes = (F.substring(dated, at, 2).cast("int") for at in (22, 24))
    ahead = (hours * 60 + minutes) * F.when(F.substring(dated, 21, 1) == "-", -60).otherwise(60)
    # As if the clock were at offset zero, whatever the session's time zone.
    there = F.concat(F.substring(dated, 1, 19), F.lit("Z")).try_cast("timestamp")
    return F.when(dated.rlike(DATED), F.timestamp_seconds(F.unix_seconds(there) - ahead))


def parse_blocks(blocks: DataFrame) -> DataFrame:
    """Parse `(repo_id, block)` rows into commit columns, plus `reject` and `extra`.

    `reject` is null for a well-formed commit, else what is wrong with the block:
    `header` (the five header lines are not all there) or `date`. `extra` holds
    the lines after the date, file lines and strays alike. Every block gives one
    row; nothing is dropped here. There is no shuffle and no Python worker.

    Only what `reject` needs is worked out in every case; a column that a query
    does not ask for is not.
    """
    lines, at = F.col("lines"), F.col("author_at")
    located = blocks.withColumn("lines", _lines(F.col("block"))).withColumn(
        "author_at", _author_index(lines)
    )
    hashed = _first_hash(F.get(lines, F.lit(0)))
    dated = F.get(lines, at + 1)
    cut = located.select(
        "repo_id",
        "block",
        "lines",
        "author_at",
        F.when(hashed.rlike(HASH), hashed).alias("commit_hash"),
        F.when(dated.startswith(DATE), after(DATE, dated)).alias("dated"),
        (
            F.get(lines, F.lit(1)).startswith(PARENTS)
            & F.get(lines, F.lit(2)).startswith(MESSAGE)
            & F.get(lines, at).startswith(AUTHOR)
        ).alias("headed"),
    ).withColumn("committed_at", _instant(F.col("dated")))
    # Spark would push a filter on `reject` down to the scan and so parse every
    # block twice; it does not push one below a generator.
    kept = ["repo_id", "block"]
    fields = [c for c in cut.columns if c not in kept]
    once = cut.select(*kept, F.inline(F.array(F.struct(*fields))))
    headed = F.col("headed") & F.col("commit_hash").isNotNull() & F.col("dated").isNotNull()
    author = F.lower(after(AUTHOR, F.get(lines, at)))
    extra = F.slice(lines, at + 3, F.greatest(F.size(lines) - at - 2, F.lit(0)))
    subject = F.when(at == 3, F.get(lines, F.lit(2))).otherwise(F.array_join(F.slice(lines, F.lit(3), at - 2), " "))
    return once.select(
        author.alias("author"),
        F.lower(F.substring(author, 1, 1)).alias("author_first_char"),
        "commit_hash",
        F.substring("dated", 1, 10).try_cast("date").alias("date"),
        F.concat(F.substring("dated", 12, 8), F.substring("dated", 21, 5)).alias("timestamp"),
        F.transform(
            F.filter(extra, _is_file_line),
            lambda x: F.struct(
                F.substring(x, 1, 1).alias("status"), strip(F.substr(x, F.lit(2))).alias("filename")
            ),
        ).alias("files"),
        after(MESSAGE, subject).alias("message"),
        F.array_remove(F.split(after(PARENTS, F.get(lines, F.lit(1))), r"\s+"), "").alias("parents"),
        "repo_id",
        "committed_at",
        F.when(~F.coalesce(headed, F.lit(False)), "header")
        .when(F.col("committed_at").isNull() | F.substring("dated", 1, 10).try_cast("date").isNull(), "date")
        .alias("reject"),
        extra.alias("extra"),
        "block",
    )


def well_formed(parsed: DataFrame) -> DataFrame:
    """The commits table: well-formed rows in the canonical columns."""
    return parsed.filter("reject IS NULL").select(*COMMITS_SCHEMA.names)


def changed_files(commits: DataFrame, *columns: str) -> DataFrame:
    """A row per changed file: the named columns (`commit_hash` if none is), `status`, `filename`.

    Commits without files have no row. Of rows that are still being parsed the file
    list is worked out once: a plain `inline` makes Spark ask for its size as well,
    by working it out again.
    """
    kept = columns or ("commit_hash",)
    return commits.select(*kept, F.inline_outer("files")).filter("status IS NOT NULL")


def _rejected() -> Column:
    """Null where nothing is: the block that was not ingested, or its stray lines."""
    body = F.rtrim(F.regexp_replace("block", "^commit: ", ""), F.lit("\r\n"))
    bad_block = F.array(F.struct(F.col("reject").alias("reason"), body.alias("text")))
    strays = F.transform(
        F.filter("extra", lambda x: ~_is_file_line(x)),
        lambda x: F.struct(F.lit("stray").alias("reason"), x.alias("text")),
    )
    some = F.size("files") < F.size("extra")
    return F.when(F.col("reject").isNotNull(), bad_block).when(some, strays)


def rejects(parsed: DataFrame) -> DataFrame:
    """`(repo_id, reason, text)`: every block not ingested and every stray line.

    A stray line (`reason` = `stray`) stands after a well-formed header but is no
    file line, such as a warning git printed into the log. A block's text comes
    without its `commit: ` and without line ends behind it, wherever it stood.
    """
    return parsed.select("repo_id", F.inline(_rejected()))


def sorted_out(parsed: DataFrame) -> DataFrame:
    """Rows for the table's two kinds: commits, and blocks that are none, with nulls for columns.

    `rejects` holds a block's rejected text, null where there is none.
    """
    good = F.col("reject").isNull()
    columns = [
        F.col(c) if c == "repo_id" else F.when(good, F.col(c)).alias(c) for c in COMMITS_SCHEMA.names
    ]
    return parsed.select(
        *columns,
        F.when(good, "commits").otherwise("rejects").alias("kind"),
        _rejected().cast(REJECTS_TYPE).alias("rejects"),
    )
