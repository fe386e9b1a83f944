"""Operator 9: quality rules learned as a decision list over text statistics.

A bounded sample of labelled documents teaches ordered rules "reject if a
statistic is beyond a threshold and ...": sequential covering grows a conjunction
on two thirds of the sample, prunes it on the rest, keeps it if it is precise
there, and goes on with what it left. The rules become one conditional
expression over columns.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commitlens.llm.rows import unused_name, with_computed

# What counts as a symbol, and the base rules.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# Labelled rows that teach the rules at most.
SAMPLE_ROWS = 20_000
MIN_PRECISION = 0.95
MIN_COVERED = 3
MAX_RULES = 32
MAX_CONDITIONS = 4
# Thresholds tried per statistic.
CUTS = 64

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE = ["n_lines", "n_upper", "n_marks", "n_digits", "n_distinct"]
STATISTICS = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS + MORE])
_UPPER, _DIGITS = bytes(range(65, 91)), bytes(range(48, 58))


def _repeated_words(words: list[bytes]) -> int:
    """Words that stand in a 3-word window found twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    often = Counter(windows)
    covered = end = 0
    for at, window in enumerate(windows):
        if often[window] > 1:
            covered += at + 3 - max(at, end)
            end = at + 3
    return covered


def statistics(text: str | None) -> tuple[int, ...]:
    """Counts of a whole text, in the order of `STATISTICS`; all 0 for a null."""
    text = text or ""
    raw = text.encode()
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line.strip()]
    spaces = sum(map(text.count, " \t\n\v\f\r"))
    return (
        len(words),
        len(text) - spaces,
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        _repeated_words(words),
        len(lines),
        len(raw) - len(raw.translate(None, _UPPER)),
        text.count("!") + text.count("?"),
        len(raw) - len(raw.translate(None, _DIGITS)),
        len(set(words)),
    )


# What rules may test: a count, or one count for each of another.
FEATURES: dict[str, tuple[str, str] | None] = {
    "n_words": None,
    "chars_per_word": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "marks_per_word": ("n_marks", "n_words"),
    "upper_per_char": ("n_upper", "word_chars"),
    "digits_per_char": ("n_digits", "word_chars"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_word_share": ("n_repeat_words", "n_words"),
    "distinct_word_share": ("n_distinct", "n_words"),
    "words_per_line": ("n_words", "n_lines"),
}


Counts = Callable[[str], Column]


def feature(name: str, count: Counts = F.col) -> Column:
    """A feature as an expression; `count` gives the column of each of `STATISTICS`."""
    parts = FEATURES[name]
    if parts is None:
        return count(name).cast("double")
    return F.coalesce(F.try_divide(count(parts[0]).cast("double"), count(parts[1])), F.lit(0.0))


def base_failed(count: Counts = F.col) -> Column:
    """Too few words, or more than half of them in repeated windows."""
    n = count("n_words")
    return (n < MIN_WORDS) | (100 * count("n_repeat_words") > MAX_REPEAT_PERCENT * n)


# --- Sequential covering, on the sample ------------------------------------------


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, values: np.ndarray) -> np.ndarray:
        return values >= self.threshold if self.above else values <= self.threshold

    def expression(self, count: Counts = F.col) -> Column:
        column = feature(self.feature, count)
        return column >= self.threshold if self.above else column <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _covered(rule: Rule, table: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, bool)
    for condition in rule:
        out &= condition.holds(table[condition.feature])
    return out


def _best_condition(table: dict[str, np.ndarray], bad: np.ndarray, inside: np.ndarray) -> Condition | None:
    """The condition with the largest information gain over the rows still inside."""
    p0, n0 = (bad & inside).sum(), (~bad & inside).sum()
    best, gain = None, 1e-9
    for name, values in table.items():
        here, is_bad = values[inside], bad[inside]
        cuts = np.unique(np.quantile(here, np.linspace(0, 1, CUTS)))
        middles = np.unique((cuts[:-1] + cuts[1:]) / 2)
        order = np.argsort(here, kind="stable")
        bad_so_far = np.concatenate(([0], np.cumsum(is_bad[order])))
        at = np.searchsorted(here[order], middles, "left")
        for above in (True, False):
            p = p0 - bad_so_far[at] if above else bad_so_far[at]
            total = len(here) - at if above else at
            with np.errstate(divide="ignore", invalid="ignore"):
                gains = p * (np.log2(p / total) - np.log2(p0 / (p0 + n0)))
            gains[p == 0] = 0
            if len(gains) and gains.max() > gain:
                i = int(gains.argmax())
                best, gain = Condition(name, above, float(middles[i])), gains[i]
    return best


def _grow(table: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    rule, inside = (), np.ones(len(bad), bool)
    while (~bad & inside).any() and len(rule) < MAX_CONDITIONS:
        condition = _best_condition(table, bad, inside)
        if condition is None:
            break
        rule += (condition,)
        inside &= condition.holds(table[condition.feature])
    return rule


def _precision(rule: Rule, table: dict[str, np.ndarray], bad: np.ndarray) -> tuple[float, int]:
    """Share of bad rows among those covered, one clean row added; and how many are bad."""
    inside = _covered(rule, table, len(bad))
    p = int((bad & inside).sum())
    return p / (int(inside.sum()) + 1), p


def learn_rules(
    table: dict[str, np.ndarray], bad: np.ndarray, min_precision: float = MIN_PRECISION
) -> list[Rule]:
    """Ordered rules that reject. Every third row prunes, the others grow."""
    table = {name: np.asarray(values, float) for name, values in table.items()}
    bad, rules = np.asarray(bad, bool), []
    left = np.ones(len(bad), bool)
    fold = np.arange(len(bad)) % 3 == 2
    while len(rules) < MAX_RULES:
        parts = []
        for rows in (left & ~fold, left & fold):
            parts.append(({name: values[rows] for name, values in table.items()}, bad[rows]))
        (grow, grow_bad), (prune, prune_bad) = parts
        if grow_bad.sum() < MIN_COVERED:
            break
        rule = _grow(grow, grow_bad)
        # The shortest beginning that is the most precise on rows it did not see.
        tried = [(_precision(rule[:k], prune, prune_bad), -k) for k in range(1, len(rule) + 1)]
        if not tried:
            break
        (precision, p), k = max(tried)
        rows = {name: values[left] for name, values in table.items()}
        all_precision, all_p = _precision(rule[:-k], rows, bad[left])
        if p < MIN_COVERED or precision < min_precision * p / (p + 1) or all_precision < min_precision * all_p / (all_p + 1):
            break
        rules.append(rule[:-k])
        left &= ~_covered(rules[-1], table, len(bad))
    return rules


# --- Over documents --------------------------------------------------------------


def with_statistics(docs: DataFrame, text: str, name: str, keep: list[str] | None = None) -> DataFrame:
    """`docs` and a struct column of `STATISTICS`."""
    return with_computed(
        docs, name, STATISTICS, F.col(text).cast("string"), lambda texts: list(map(statistics, texts)), keep
    )


def labelled_sample(
    docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, rows: int
) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Features and badness of at most `rows` labelled documents that pass the base rules.

    Those whose keys hash lowest are taken, so the same ones on every run.
    """
    chosen = (
        labels.select(F.col(key).cast("long").alias("__key"), F.col(label).cast("int").alias("__label"))
        .dropna()
        .orderBy(F.xxhash64("__key"), "__key", "__label")
        .limit(rows)
    )
    texts = docs.select(F.col(key).cast("long").alias("__key"), F.col(text).alias("__text"))
    # At most `rows` rows are broadcast and come back: of rows that repeat a key one text, the least by hash.
    least = F.min_by("__text", F.struct(F.xxhash64("__text"), "__text")).alias("__text")
    keys = F.broadcast(chosen.select("__key").distinct())
    once = texts.join(keys, "__key", "leftsemi").groupBy("__key").agg(least)
    found = with_statistics(once.join(F.broadcast(chosen), "__key"), "__text", "__s", ["__key", "__label"])
    flat = found.select("__key", "__label", "__s.*").filter(~base_failed())
    numbers = [feature(name).alias(name) for name in FEATURES]
    table = flat.select("__label", *(n.alias(f"f_{name}") for n, name in zip(numbers, FEATURES)), "__key")
    table = table.toPandas().sort_values(["__key", *(f"f_{name}" for name in FEATURES)], kind="stable")
    columns = {name: table[f"f_{name}"].to_numpy(float) for name in FEATURES}
    return columns, table["__label"].to_numpy() == 0


def rules_of(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
    min_precision: float = MIN_PRECISION,
) -> list[Rule]:
    """The learned list; empty where labels show nothing to reject."""
    table, bad = labelled_sample(docs, labels, key, text, label, sample_rows)
    return learn_rules(table, bad, min_precision)


def matching_rule(rules: list[Rule], count: Counts = F.col) -> Column:
    """Number of the first rule that holds, from 1; null where none does."""
    out = F.lit(None).cast("int")
    for number, rule in reversed(list(enumerate(rules, 1))):
        holds = F.lit(True)
        for condition in rule:
            holds = holds & condition.expression(count)
        out = F.when(holds, F.lit(number)).otherwise(out)
    return out


def score_quality(docs: DataFrame, rules: list[Rule], key: str = "doc_id", text: str = "text") -> DataFrame:
    """`(key, counts..., base_failed, rule, kept)` of every row.

    `rule` is the number of the first learned rule that rejects the document.
    Nulls and empty texts have counts of 0 and fail the base rules. Rows with
    null or repeated keys are scored like any other. Other columns are not read.
    """
    found = with_statistics(docs.select(key, text), text, "__s", [key])
    return (
        found.select(key, "__s.*")
        .select(key, *COUNTS, base_failed().alias("base_failed"), matching_rule(rules).alias("rule"))
        .withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
    )


def keep_good(docs: DataFrame, rules: list[Rule], text: str = "text") -> DataFrame:
    """The rows of `docs` that neither the base rules nor a learned rule reject, columns unchanged."""
    name = unused_name(docs, "__s")
    scored = with_statistics(docs, text, name)

    def count(field: str) -> Column:
        return F.col(name)[field]

    return scored.filter(~base_failed(count) & matching_rule(rules, count).isNull()).drop(name)
