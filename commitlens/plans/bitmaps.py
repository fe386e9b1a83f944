"""Who contributed to any subset of repositories: a bitmap of repositories per author.

Bitmaps are made by one pass over the commits and then answer for any number of
subsets at once, by bit operations on words of 64 repositories.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_WORD = 64


def _word_of(number: Column) -> Column:
    return F.floor(number / _WORD).cast("int")


def _bit_of(number: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), (number % _WORD).cast("int"))


class Bitmaps:
    """`words`: `(author, word, bits)`, a row per 64 repositories that an author has some of.

    `numbers`: `(repo_id, number)`, a row per repository.
    """

    def __init__(self, words: DataFrame, numbers: DataFrame):
        self.words, self.numbers = words, numbers


def author_bitmaps(commits: DataFrame) -> Bitmaps:
    """The bitmaps of all authors. Persist or store `words` and `numbers` to ask more than once."""
    pairs = commits.select("author", "repo_id").distinct()
    # One row per repository goes through one task.
    numbers = commits.select("repo_id").distinct().select(
        "repo_id", (F.row_number().over(Window.orderBy("repo_id")) - 1).alias("number")
    )
    numbered = pairs.join(numbers, "repo_id").select("author", _word_of(F.col("number")).alias("word"), _bit_of(F.col("number")).alias("bit"))
    words = numbered.groupBy("author", "word").agg(F.bit_or("bit").alias("bits"))
    return Bitmaps(words, numbers)


def contributors_of(
    bitmaps: Bitmaps, subsets: dict[str, list[str]], all_of: bool = False, at_least: int = 1
) -> DataFrame:
    """`(subset, author, repos)`: in how many of a subset's repositories an author has commits.

    Authors with at least so many, or with `all_of` with each; a repository that is
    not there has no author. All subsets are answered by one look at the bitmaps.
    """
    spark = bitmaps.words.sparkSession
    named = [(name, repo, len(set(repos))) for name, repos in subsets.items() for repo in dict.fromkeys(repos)]
    asked = spark.createDataFrame(named, "subset string, repo_id string, size int")
    masks = (
        asked.join(bitmaps.numbers, "repo_id")
        .groupBy("subset", "size", _word_of(F.col("number")).alias("word"))
        .agg(F.bit_or(_bit_of(F.col("number"))).alias("mask"))
    )
    hits = F.bit_count(F.col("bits").bitwiseAND(F.col("mask")))
    counted = bitmaps.words.join(masks, "word").withColumn("hits", hits).filter("hits > 0")
    counted = counted.groupBy("subset", "size", "author").agg(F.sum("hits").alias("repos"))
    enough = F.col("repos") == F.col("size") if all_of else F.col("repos") >= at_least
    return counted.filter(enough).select("subset", "author", "repos")
