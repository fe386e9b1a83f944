"""Operator 10: language by compression.

A text is coded once per language with zstandard, primed by a dictionary of raw
text in that language; the language whose dictionary codes it shortest is its
own. Long texts are coded in blocks, all of them, so that the dictionary counts
throughout. Where two languages code a text about equally short, it is rejected.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Callable, Iterable, Iterator

import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commitlens.llm.rows import unused_name, with_computed

# Bytes of raw text learned per language at most; texts sampled for it, and characters
# taken of each.
LEARNED_BYTES = 1 << 17
SAMPLE_ROWS = 400
SAMPLE_CHARS = 1024
# Bytes coded at once.
BLOCK_BYTES = 1 << 13
# Bytes of text that one language codes before the next does.
GROUP_BYTES = 1 << 20
# How every text is coded, whatever its length: matches from four bytes on.
SETTINGS = dict(
    window_log=18, chain_log=18, hash_log=17, min_match=4, search_log=4,
    strategy=zstandard.STRATEGY_BTLAZY2, write_content_size=0, write_checksum=0,
)
# Fewest bytes that a dictionary may have; less is repeated.
_LEAST_RAW = 8
# Bytes of difference that make a language e times likelier.
SCALE_BYTES = 1.5
MIN_MARGIN = 0.01
UNDETERMINED = "und"

# Words of letters, those one space apart found at once; possessive, so that nothing is kept for a way back.
_WORDS = re.compile(r"[^\W\d_]++(?: [^\W\d_]++)*+")


def normalised(text: str | None) -> str:
    """Lower-cased words of letters with single spaces; empty if there is no letter."""
    words = " ".join(_WORDS.findall((text or "").lower()))
    return words if any(map(str.isalpha, words)) else ""


def _groups(raws: Iterable[bytes], size: int) -> Iterator[list[bytes]]:
    """`raws` in lists, each closed by the text that brings it to `size` bytes."""
    group, held = [], 0
    for raw in raws:
        group.append(raw)
        held += len(raw)
        if held >= size:
            yield group
            group, held = [], 0
    yield group


def _coder(raw: bytes) -> zstandard.ZstdCompressor:
    raw = b"\n".join([raw] * -(-_LEAST_RAW // len(raw)))
    parameters = zstandard.ZstdCompressionParameters(**SETTINGS)
    primed = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    primed.precompute_compress(compression_params=parameters)
    return zstandard.ZstdCompressor(compression_params=parameters, dict_data=primed)


class Compressors:
    """Primed compressors of each language that has some text, however little."""

    def __init__(self, learned: dict[str, bytes]):
        self.languages = sorted(language for language, raw in learned.items() if raw)
        self.coders = [_coder(learned[language]) for language in self.languages]

    def sizes(self, text: str) -> list[int]:
        """Coded bytes of the whole text per language."""
        return self.sizes_of([text.encode()])[0]

    def sizes_of(self, raws: list[bytes]) -> list[list[int]]:
        """Coded bytes of each whole text per language.

        A language codes all texts before the next one does: its dictionary's tables
        fill the processor's cache, and those of the next push them out.
        """
        found: list[list[int]] = [[] for _ in raws]
        for coder in self.coders:
            for raw, sizes in zip(raws, found):
                blocks = (raw[at : at + BLOCK_BYTES] for at in range(0, len(raw), BLOCK_BYTES))
                sizes.append(sum(len(coder.compress(b)) for b in blocks))
        return found

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """Language, score from 0 to 1, and margin: what the next best costs more, as a share.

        Ties go to the language that sorts first. A null, or a text without a
        letter, is `und` with score and margin 0.
        """
        return self.predict_all([text])[0]

    def predict_all(self, texts: Iterable[str | None]) -> list[tuple[str, float, float]]:
        """`predict` of each text; coded texts are held a group of `GROUP_BYTES` at a time."""
        raws = (normalised(text).encode() for text in texts)
        return [self._decided(sizes) for group in _groups(raws, GROUP_BYTES) for sizes in self.sizes_of(group)]

    def _decided(self, sizes: list[int]) -> tuple[str, float, float]:
        # Only a text without a letter has no coded bytes.
        if not any(sizes):
            return UNDETERMINED, 0.0, 0.0
        best = min(sizes)
        if len(sizes) == 1:
            return self.languages[0], 1.0, 1.0
        score = 1 / sum(math.exp((best - size) / SCALE_BYTES) for size in sizes)
        margin = (sorted(sizes)[1] - best) / max(best, 1)
        return self.languages[sizes.index(best)], score, margin


# The compressors that a worker made last, by what they were learned from.
_loaded: dict[str, Compressors] = {}


def learn_dictionaries(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    rows: int = SAMPLE_ROWS,
    size: int = LEARNED_BYTES,
    chars: int = SAMPLE_CHARS,
) -> dict[str, bytes]:
    """Raw content per language, from at most `rows` of its texts and `size` bytes.

    Those whose keys hash lowest, `chars` characters of each at a hashed offset. Null
    languages, texts or keys teach nothing; a language none of whose texts has a
    letter is not learned, any other is, of however little text.
    """
    order = Window.partitionBy("lang").orderBy(F.xxhash64("key"), "key", F.xxhash64("text"))
    room = F.greatest(F.length("text") - chars, F.lit(0)) + 1
    start = (F.pmod(F.xxhash64("key", "text"), room) + 1).cast("int")
    columns = [F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text")]
    sample = (
        docs.select(*columns, F.col(lang).cast("string").alias("lang"))
        .dropna()
        .select("lang", "key", F.col("text").substr(start, F.lit(chars)).alias("text"))
        .withColumn("n", F.row_number().over(order))
        .filter(F.col("n") <= rows)
    )
    parts: dict[str, list[str]] = {}
    for row in sample.orderBy("lang", "n").toLocalIterator():
        parts.setdefault(row["lang"], []).append(normalised(row["text"]))
    joined = {language: "\n".join(filter(None, found)).encode()[:size] for language, found in parts.items()}
    return {language: raw for language, raw in joined.items() if raw}


RESULT = T.StructType(
    [
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("margin", T.DoubleType()),
    ]
)


def with_language(
    docs: DataFrame, dictionaries: dict[str, bytes], text: str, name: str, keep: list[str] | None = None
) -> DataFrame:
    """`docs` and a struct column of `RESULT`; dictionaries are as large as there are languages."""
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)
    content = hashlib.sha1(repr(sorted(dictionaries.items())).encode()).hexdigest()

    def compute(texts: list[str | None]) -> list[dict]:
        if content not in _loaded:
            _loaded.clear()
            _loaded[content] = Compressors(shared.value)
        coders = _loaded[content]
        return [dict(zip(RESULT.names, found)) for found in coders.predict_all(texts)]

    return with_computed(docs, name, RESULT, F.col(text).cast("string"), compute, keep)


def identify_language(
    docs: DataFrame, dictionaries: dict[str, bytes], key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """`(key, lang_pred, score, margin, rejected)` of every row.

    `rejected` marks narrow decisions: the next best language costs less than the
    share `MIN_MARGIN` more. Nulls, empty texts and texts
    without a letter are `und`, score 0, rejected. Repeated rows and null keys
    are rows like others; nothing but the text is looked at.
    """
    found = with_language(docs.select(key, text), dictionaries, text, "__l", [key])
    return found.select(key, "__l.*").withColumn("rejected", _narrow(F.col))


def _narrow(field: Callable[[str], Column]) -> Column:
    return field("margin") < MIN_MARGIN


def keep_identified(docs: DataFrame, dictionaries: dict[str, bytes], text: str = "text") -> DataFrame:
    """The rows of `docs` whose language is clear, columns unchanged."""
    name = unused_name(docs, "__l")
    found = with_language(docs, dictionaries, text, name)
    return found.filter(~_narrow(lambda field: F.col(name)[field])).drop(name)
