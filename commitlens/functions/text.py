"""Small text expressions shared by the parser."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python's str.strip() treats as white space; none lies above U+3000.
WHITESPACE = "".join(filter(str.isspace, map(chr, range(0x3001))))


def _is_plain(char: Column) -> Column:
    """Is this a visible ASCII character?"""
    return F.ascii(char).between(33, 126)


def strip(text: Column) -> Column:
    """Strip white space of every kind (plain `trim` strips spaces only).

    The wide set is tried only where an end of the text is no plain character.
    """
    plain = _is_plain(text) & _is_plain(F.substring(text, -1, 1))
    return F.when(plain, text).otherwise(F.trim(text, F.lit(WHITESPACE)))


def after(prefix: str, line: Column) -> Column:
    """The stripped rest of `line` after `prefix`."""
    return strip(F.ltrim(F.substr(line, F.lit(len(prefix) + 1))))
