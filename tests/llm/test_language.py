import math
import random
import re

from pyspark.sql import functions as F

from commitlens.llm import language
from commitlens.llm.language import (
    BLOCK_BYTES,
    LEARNED_BYTES,
    Compressors,
    identify_language,
    keep_identified,
    learn_dictionaries,
    normalised,
)
from tests.llm.conftest import odd_rows, with_clashes


def test_normalised():
    assert normalised("  The 3 cats_&\n ÉCOLE²! ") == "the cats école²"
    assert normalised("12 ... _ ²") == normalised(None) == normalised("") == ""


def test_learns_within_bounds_and_only_from_what_it_may(spark):
    rows = [(i, "guten tag meine damen und herren " * 300, "de") for i in range(300)]
    rows += [(i, None, "en") for i in range(50)] + [(None, "hello there", "en"), (7, "texto sin lengua", None)]
    found = learn_dictionaries(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert list(found) == ["de"] and len(found["de"]) <= LEARNED_BYTES


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    found = identify_language(docs, learn_dictionaries(docs.filter(~held_out)))
    joined = found.join(docs.filter(held_out), "doc_id").filter(F.length("text") > 40).collect()
    right = sum(r["lang"] == r["lang_pred"] for r in joined)
    # About one label in a hundred is wrong.
    assert len(joined) > 200 and right >= 0.97 * len(joined)
    assert all(0 <= r["score"] <= 1 for r in joined)


def test_result_is_the_smallest_code():
    learned = {"x": b"lorem ipsum dolor sit amet " * 200, "y": b"the quick brown fox jumps over it " * 200}
    coders = Compressors(learned)
    for text in ("the quick brown fox", "lorem ipsum", "fox " * 5000, "dolor sit amet lorem " * 300):
        sizes = coders.sizes(normalised(text))
        lang, score, margin = coders.predict(text)
        assert lang == coders.languages[sizes.index(min(sizes))] and 0 <= score <= 1 and margin >= 0
        assert math.isclose(margin, (max(sizes) - min(sizes)) / max(min(sizes), 1))
    assert Compressors({}).predict("words")[0] == "und"
    assert Compressors({"x": b"only one language"}).predict("words") == ("x", 1.0, 1.0)


def test_odd_rows(odd_docs, no_docs):
    docs = with_clashes(odd_docs, "lang_pred", "score", "margin", "__l", "rejected")
    learned = {"en": b"the old house and the young family from the city " * 50, "de": b"das alte haus und die junge familie der stadt " * 50}
    found = identify_language(docs, learned).collect()
    assert len(found) == len(odd_rows())
    by_key = {r["doc_id"]: r for r in found}
    assert [by_key[k]["lang_pred"] for k in (1, 2, 3, 6, 7, 8)] == ["und"] * 4 + ["en", "de"]
    assert all(by_key[k]["rejected"] and by_key[k]["score"] == 0 for k in (1, 2, 3, 6))
    kept = keep_identified(docs, learned)
    assert kept.columns == docs.columns
    assert kept.count() == sum(not r["rejected"] for r in found)
    assert identify_language(no_docs, learned).count() == 0 and learn_dictionaries(no_docs) == {}


def test_short_and_long_texts_are_measured_alike():
    learned = {"x": b"lorem ipsum dolor sit amet " * 200, "y": b"the quick brown fox jumps over it " * 200}
    coders = Compressors(learned)
    text = "the lorem quick ipsum fox dolor " * 40
    for n in range(380, 420):
        raw = text[:n].encode()
        assert coders.sizes(text[:n]) == [len(c.compress(raw)) for c in coders.coders]


def test_little_text_is_learned(spark):
    rows = [(1, "oui", "fr"), (2, "yes of course it is", "en"), (3, "12 ...", "xx"), (4, "d'accord", "fr")]
    learned = learn_dictionaries(spark.createDataFrame(rows[:3], "doc_id long, text string, lang string"))
    assert sorted(learned) == ["en", "fr"] and learned["fr"] == b"oui"
    assert Compressors(learned).languages == ["en", "fr"]
    assert Compressors({"fr": b"a", "en": b""}).languages == ["fr"]


def test_dictionaries_learn_more_than_openings(spark):
    rows = [(i, "licence " * 200 + "body " * 1000, "en") for i in range(20)]
    learned = learn_dictionaries(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert learned["en"].count(b"body") > learned["en"].count(b"licence")


def test_normalised_splits_at_every_other_character():
    draw = random.Random(3)
    letters = "ab Z É ß İ ² ½ ١ 7 _ . - \u0301 \u00a0 \u2028 \n \t 漢 ʼ \U0001d7d9 \U0001f600".split(" ") + [" "] * 6
    for _ in range(5000):
        text = "".join(draw.choices(letters, k=draw.randrange(20)))
        words = re.sub(r"[\W\d_]+", " ", text.lower()).strip()
        assert normalised(text) == (words if any(map(str.isalpha, words)) else "")


class _Noted:
    """A coder that notes its name at every call."""

    def __init__(self, coder, name, calls):
        self.coder, self.name, self.calls = coder, name, calls

    def compress(self, raw):
        self.calls.append((self.name, len(raw)))
        return self.coder.compress(raw)


def test_a_language_codes_a_group_of_texts_before_the_next_does(monkeypatch):
    learned = {"x": b"lorem ipsum dolor sit amet " * 200, "y": b"the quick brown fox jumps over it " * 200}
    plain, noted, calls = Compressors(learned), Compressors(learned), []
    noted.coders = [_Noted(c, n, calls) for c, n in zip(noted.coders, noted.languages)]
    texts = ["the fox", None, "lorem ipsum " * 2000, "", "12", "dolor sit the amet quick"] * 20
    monkeypatch.setattr(language, "GROUP_BYTES", 100_000)
    found = noted.predict_all(texts)
    assert found == [plain.predict(t) for t in texts] and found[1] == ("und", 0.0, 0.0)
    # Every text whole in each language, in blocks.
    whole = sum(len(normalised(t)) for t in texts)
    assert [sum(n for name, n in calls if name == x) for x in "xy"] == [whole, whole]
    assert max(n for _, n in calls) == BLOCK_BYTES
    # A group ends with the text that fills it: five long ones, four times.
    switches = sum(a[0] != b[0] for a, b in zip(calls, calls[1:]))
    assert switches <= 2 * (whole // 100_000 + 1) - 1
    assert noted.predict_all([]) == [] and Compressors({}).predict_all(["a", None]) == [("und", 0.0, 0.0)] * 2
