import corpus_pipeline
import pytest

from commitlens.llm.quality import rules_of, score_quality
from commitlens.llm.simhash import simhash_groups
from commitlens.scratch import stored
from tests.llm.conftest import odd_rows, with_clashes
from tests.llm.test_packing import check_pieces


@pytest.fixture(scope="module")
def steps(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], small)))
    return out


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_stages_keep_the_columns_and_shrink(steps):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "language", "near_duplicates", "mixture", "packing"]
    for df in steps[1:-1]:
        assert df.dtypes == steps[0].dtypes and df.count() > 0
    assert ids(steps[1]) < ids(steps[0]) or set(ids(steps[1])) <= set(ids(steps[0]))


def test_quality_stage(spark, small, steps):
    rules = rules_of(steps[0], spark.read.parquet(f"{small}/labels.parquet"))
    assert ids(steps[1]) == ids(score_quality(steps[0], rules).filter("kept"))


def test_language_stage_keeps_clean_documents(steps):
    assert len(ids(steps[2])) >= 0.98 * len(ids(steps[1]))


def test_one_of_each_group_is_left(steps):
    groups = simhash_groups(steps[2])
    assert ids(steps[3]) == sorted(r[0] for r in groups.select("component").distinct().collect())


def test_mixture_takes_rows_as_they_are(steps):
    before, after = (set(map(tuple, df.collect())) for df in steps[3:5])
    assert after <= before


def test_packing_holds_every_document(steps):
    check_pieces(steps[5].collect(), [tuple(r) for r in steps[4].select("doc_id", "text").collect()], 2048)


def test_run_is_the_stages_in_turn(spark, small, steps):
    run = corpus_pipeline.run(spark, small)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, run.select(*columns).collect())) == sorted(map(tuple, steps[5].select(*columns).collect()))


def test_stages_take_odd_rows_and_empty_tables(spark, small, odd_docs, no_docs):
    for docs in (with_clashes(odd_docs, "kept", "score", "key", "fp", "tokens", "epoch"), no_docs):
        for name, stage in corpus_pipeline.STAGES:
            found = stage(spark, docs, small)
            if name != "packing":
                assert found.columns == docs.columns
            assert found.count() <= 3 * len(odd_rows()) + 100
