"""Names for working columns."""

from pyspark.sql import DataFrame


def unused(base: str, *tables: DataFrame) -> str:
    """`base`, with underscores behind it until no column of the tables is called so, in any case."""
    taken = {c.lower() for table in tables for c in table.columns}
    while base.lower() in taken:
        base += "_"
    return base


def quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"
