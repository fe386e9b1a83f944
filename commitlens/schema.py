"""The commits table: columns, partition keys and the file-status alphabet."""

from pyspark.sql import types as T

FILE_TYPE = T.StructType(
    [
        T.StructField("status", T.StringType()),
        T.StructField("filename", T.StringType()),
    ]
)

# The table's column names and its two partition columns.
COMMITS_SCHEMA = T.StructType(
    [
        T.StructField("author", T.StringType()),
        T.StructField("author_first_char", T.StringType()),
        T.StructField("commit_hash", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("files", T.ArrayType(FILE_TYPE)),
        T.StructField("message", T.StringType()),
        T.StructField("parents", T.ArrayType(T.StringType())),
        T.StructField("repo_id", T.StringType()),
        T.StructField("committed_at", T.TimestampType()),
    ]
)
# What was not ingested from a block: the whole of it, or single lines.
REJECTS_TYPE = T.ArrayType(
    T.StructType([T.StructField("reason", T.StringType()), T.StructField("text", T.StringType())])
)
# What a load keeps for the reports: `part` says which of the other columns a row fills.
ROLLUP_SCHEMA = T.StructType(
    [
        T.StructField("repo_id", T.StringType()),
        T.StructField("part", T.StringType()),
        T.StructField("month", T.DateType()),
        T.StructField("author", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("sketch", T.BinaryType()),
    ]
)
PARTITION_COLUMNS = ["repo_id", "author_first_char"]
VIEW_NAME = "commits"

# Status letters of `git log --name-status` and the report's labels.
STATUSES = ["A", "B", "C", "D", "M", "R", "T", "U", "X"]
STATUS_LABELS = {"M": "Modified", "R": "Renamed", "A": "Added", "D": "Deleted"}
