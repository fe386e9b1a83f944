"""One query per operator of this subpackage, with production parameters."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commitlens.llm.hard_negatives import mine_hard_negatives
from commitlens.llm.html_text import extract_text
from commitlens.llm.language import identify_language, learn_dictionaries
from commitlens.llm.mixing import Level, mix
from commitlens.llm.ngram_filter import score_texts
from commitlens.llm.packing import pack
from commitlens.llm.periodic_runs import periodic_runs, run_digest, words_of
from commitlens.llm.quality import rules_of, score_quality
from commitlens.llm.shingle_join import shingle_components
from commitlens.llm.simhash import simhash_groups
from commitlens.llm.token_store import scan_token_store, write_token_store
from commitlens.llm.tokens import default_tokenizer
from commitlens.llm.vector_index import search
from commitlens.llm.warc import read_warc, write_warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mixture_levels() -> list[Level]:
    """Domain, language and source; a source's number names its domain."""
    number = F.regexp_extract("source", "([0-9]+)$", 1)
    domain = F.when(number != "", F.concat(F.lit("d"), F.right(number, F.lit(1)).cast("int") % 3))
    return [
        Level("domain", F.coalesce(domain, F.lit("other")), F.expr("CASE domain WHEN 'd0' THEN 5 WHEN 'd1' THEN 3 ELSE 2 END")),
        Level("lang", F.col("lang"), F.expr("CASE WHEN lang = 'en' THEN 4 ELSE 2 END")),
        Level("source", F.col("source"), F.lit(1)),
    ]


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_token_store(_table(spark, sf_dir, "documents"), default_tokenizer(), end_id=1)
    return scan_token_store(manifest)


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(_table(spark, sf_dir, "pages"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = read_warc(write_warc(_table(spark, sf_dir, "pages")), payload=False)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "status")


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_table(spark, sf_dir, "documents"), mixture_levels(), percent=80, max_epochs=3, seed=17)


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"), default_tokenizer(), end_id=0, capacity=2048)


def op6_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(_table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20)


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_groups(_table(spark, sf_dir, "documents"), shingle=4, distance=4)
    hexadecimal = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", hexadecimal.alias("fingerprint"), F.col("component").alias("component_id"))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    return score_texts(_table(spark, sf_dir, "documents"), ~held_out, min_pair_count=1)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return score_quality(docs, rules_of(docs, _table(spark, sf_dir, "labels"))).drop("rule")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(True))
    dictionaries = learn_dictionaries(docs.filter(~held_out))
    return identify_language(docs, dictionaries).withColumn("held_out", held_out)


def op11_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = shingle_components(_table(spark, sf_dir, "documents"), shingle=3, percent=90)
    return found.withColumnRenamed("component", "component_id")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END")
    return mine_hard_negatives(_table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, label)


def planted_words(key: int | None, text: str | None) -> list[bytes]:
    """A text's words; for a tenth of the keys, all from some word on repeat with a period."""
    words = words_of(key, text)
    rest, tenth = divmod(zlib.crc32(str(key).encode()), 10)
    if key is None or tenth or not words:
        return words
    at = rest % len(words)
    period = 1 + (len(words) - at) // (3 + rest % 8)
    root = words[at : at + period]
    return words[:at] + (root * (-(-(len(words) - at) // period)))[: len(words) - at]


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digest(periodic_runs(_table(spark, sf_dir, "documents"), min_length=12, words=planted_words))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_store": op1_token_store,
        "op2_html_extraction": op2_html_extraction,
        "op3_warc": op3_warc,
        "op4_source_mixing": op4_source_mixing,
        "op5_best_fit_packing": op5_best_fit_packing,
        "op6_vector_search": op6_vector_search,
        "op7_simhash_near_dedup": op7_simhash_near_dedup,
        "op8_lm_scoring": op8_lm_scoring,
        "op9_quality_rules": op9_quality_rules,
        "op10_language_id": op10_language_id,
        "op11_shingle_join": op11_shingle_join,
        "op12_hard_negatives": op12_hard_negatives,
        "op13_periodic_runs": op13_periodic_runs,
    }


def _split_sql(depth: int) -> str:
    """Budgets of one level of the tree, in SQL of its own: the same water level, per family."""
    path = ["domain", "lang", "source"][: depth + 1]
    parents, name = path[:-1], path[-1]
    family = f"PARTITION BY {', '.join(parents)}" if parents else ""
    along = f"({family} ORDER BY CASE WHEN weight > 0 THEN CAST(lim AS DOUBLE) / weight END NULLS LAST, {name} NULLS LAST"
    match = " AND ".join(f"n.{c} IS NOT DISTINCT FROM b.{c}" for c in parents) or "true"
    return f"""
    nodes{depth} AS (
        SELECT {", ".join("n." + c for c in path)}, lim, weight, b.budget FROM (
            SELECT {", ".join(path)}, CAST(sum(lim) AS BIGINT) AS lim, max(w{depth}) AS weight
            FROM leaves GROUP BY {", ".join(path)}) AS n
        JOIN {f"budgets{depth - 1}" if depth else "root"} AS b ON {match}),
    filled{depth} AS (
        SELECT *, weight = 0 OR lim * sum(weight) OVER {along} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
            <= (budget - coalesce(sum(lim) OVER {along} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * weight
            AS is_full
        FROM nodes{depth}),
    open{depth} AS (
        SELECT *, budget - coalesce(sum(lim) FILTER (is_full) OVER ({family}), 0) AS rest,
            sum(weight) FILTER (NOT is_full) OVER ({family}) AS open_weight,
            sum(weight) FILTER (NOT is_full) OVER {along} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
        FROM filled{depth}),
    budgets{depth} AS (
        SELECT {", ".join(path)}, CAST(CASE WHEN is_full THEN lim
            ELSE rest * upto // open_weight - rest * (upto - weight) // open_weight END AS BIGINT) AS budget
        FROM open{depth})"""


_MIX_SQL = f"""
WITH light AS (
    SELECT doc_id, lang, source,
        CASE WHEN regexp_extract(source, '([0-9]+)$', 1) <> ''
            THEN 'd' || CAST(right(source, 1) AS INT) % 3 ELSE 'other' END AS domain,
        len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS tokens
    FROM documents),
leaves AS (
    SELECT domain, lang, source, CAST(sum(tokens) AS BIGINT) AS tokens, CAST(3 * sum(tokens) AS BIGINT) AS lim,
        CASE domain WHEN 'd0' THEN 5 WHEN 'd1' THEN 3 ELSE 2 END AS w0,
        CASE WHEN lang = 'en' THEN 4 ELSE 2 END AS w1, 1 AS w2
    FROM light GROUP BY ALL),
root AS (SELECT least(sum(tokens) * 80 // 100, sum(lim)) AS budget FROM leaves),
{_split_sql(0)},
{_split_sql(1)},
{_split_sql(2)},
plan AS (
    SELECT l.domain, l.lang, l.source, coalesce(b.budget // nullif(l.tokens, 0), 0) AS epochs,
        b.budget - coalesce(b.budget // nullif(l.tokens, 0), 0) * l.tokens AS rest
    FROM leaves AS l JOIN budgets2 AS b ON l.domain IS NOT DISTINCT FROM b.domain
        AND l.lang IS NOT DISTINCT FROM b.lang AND l.source IS NOT DISTINCT FROM b.source),
drawn AS (
    SELECT d.*, epochs, rest, sum(tokens) OVER (
            PARTITION BY d.domain, d.lang, d.source ORDER BY md5('17:' || epochs || ':' || coalesce(CAST(doc_id AS VARCHAR), 'null'))
            RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW EXCLUDE TIES)
        - tokens AS start
    FROM light AS d JOIN plan AS p ON d.domain IS NOT DISTINCT FROM p.domain
        AND d.lang IS NOT DISTINCT FROM p.lang AND d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, domain, lang, source, CAST(tokens AS BIGINT) AS tokens, CAST(epoch AS INT) AS epoch
FROM (SELECT *, unnest(range(CAST(epochs + CASE WHEN start < rest THEN 1 ELSE 0 END AS BIGINT))) AS epoch FROM drawn)"""


_HARD_SQL = """
WITH usable AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scored AS (
    SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
        CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
    FROM usable AS a JOIN usable AS r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score
    FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place
          FROM scored WHERE same)
    WHERE place <= 5),
ranked AS (
    SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
        row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS place
    FROM positives AS p JOIN scored AS s ON p.anchor_id = s.anchor_id AND NOT s.same
        AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score)
SELECT anchor_id, positive_id, CAST(place AS INT) AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE place <= 5"""


def oracle_sql() -> dict[str, str]:
    return {"op4_source_mixing": _MIX_SQL, "op12_hard_negatives": _HARD_SQL}
