import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SENTENCES = {
    "en": "the old house on the hill was sold to a young family that came from the city last week",
    "de": "das alte haus auf dem berg wurde letzte woche an eine junge familie aus der stadt verkauft",
}


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    rows = [
        (1, None, "en", "src0", 0),
        (2, "", None, None, None),
        (None, "a text without a key", "en", "src1", 20),
        (None, None, None, None, None),
        (3, " \n\t ", "de", "src1", 4),
        (4, "word " * 60_000, "en", "src0", 300_000),
        (5, "Straße ÉCOLE 中文 😀 ok\x1f x y", "de", "src2", 30),
        (6, "...!!! 12 34", "en", "src2", 12),
        (7, SENTENCES["en"], "en", "src3", 80),
        (8, SENTENCES["de"], "de", "src3", 80),
        (9, SENTENCES["en"], "en", "src4", 80),
    ]
    return rows + [rows[8], rows[8], rows[2]]


@pytest.fixture(scope="session")
def odd_docs(spark):
    return spark.createDataFrame(odd_rows(), DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def documents(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")


def with_clashes(df, *names):
    """`df` with more columns, called like those that operators work with."""
    from pyspark.sql import functions as F

    return df.withColumns({name: F.lit(7) for name in names if name not in df.columns})
