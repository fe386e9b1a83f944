import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from commitlens.llm import tokens
from commitlens.llm.token_store import PerfectHash, ShardIndex, look_up, scan_token_store, write_token_store
from commitlens.llm.tokens import TextEncoder, default_tokenizer
from tests.llm.conftest import odd_rows, with_clashes


@pytest.fixture(scope="module")
def encoder():
    return TextEncoder(default_tokenizer())


def encode(text, end):
    found = Tokenizer.from_file(default_tokenizer()).encode(text or "", add_special_tokens=False)
    return np.array([*found.ids, end], "<u4")


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="abAB .,'\n\x01\x1c\xa0éÉßİ中1<|>endoftext", max_size=40), max_size=5))
def test_ids_are_the_tokenizers_own(encoder, texts):
    assert encoder.by_word
    assert encoder.encode(texts) == encoder._plain(texts)


def test_words_met_again_are_learned_once_and_memory_is_bounded(encoder, monkeypatch):
    monkeypatch.setattr(tokens, "MAX_CACHED_WORDS", 200)
    own, learned = TextEncoder(default_tokenizer()), []
    monkeypatch.setattr(own, "_learn", lambda words, learn=own._learn: (learned.extend(words), learn(words)))
    for i in range(40):
        texts = ["common words, déjà vu", " ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26)}{chr(97 + j)}" for j in range(20))]
        assert own.encode(texts) == encoder._plain(texts)
        assert len(own.ids) + len(own.old) <= 200 + 2 * 30
    assert [learned.count(w) for w in (b"common", b"vu", "déjà".encode())] == [1, 1, 1]


def test_words_of_plain_letters_go_to_the_model_alone(encoder, monkeypatch):
    own = TextEncoder(default_tokenizer())
    text = "Straße, naïve ÿ æon zebra. déjà"
    want, asked = encoder._plain([text]), []
    monkeypatch.setattr(own, "_plain", lambda texts, plain=own._plain: (asked.extend(texts), plain(texts))[1])
    assert own.encode([text]) == want
    assert sorted(" ".join(asked).split(" \x01 ")) == [",", "."]


def test_ids_of_special_marks_and_nulls(encoder):
    texts = ["a<|endoftext|>b", "<|STARTOFTEXT|>", None, "don't THEY'RE ., x.", "x,. ,x"]
    assert encoder.encode(texts) == encoder._plain([t or "" for t in texts])


@given(st.sets(st.integers(-(2**63) + 1, 2**63 - 1), max_size=400))
def test_perfect_hash_is_minimal(keys):
    keys = np.array(sorted(keys), np.int64)
    assert sorted(PerfectHash.build(keys).slots(keys).tolist()) == list(range(len(keys)))


def test_index_survives_bytes_and_knows_strangers():
    keys = np.array([-5, 3, 3, 9, 100], np.int64)
    index = ShardIndex.from_bytes(ShardIndex.build(keys, np.array([1, 2, 3, 4, 5]), 2).to_bytes())
    row, n = index.lookup(np.array([3, 100, -5, 4, 0, 77]))
    assert row.tolist() == [1, 4, 0, -1, -1, -1] and n.tolist() == [2, 1, 1, 0, 0, 0]
    assert index.starts.tolist() == [0, 1, 3, 6, 10, 15]


def expected(rows):
    """Nulls first, then by key; `start` counts all ids before, whatever rows tie."""
    out = {}
    for key in sorted({r[0] for r in rows}, key=lambda k: (k is not None, k or 0)):
        out[key] = sorted((len(encode(r[1], 1)), zlib.crc32(encode(r[1], 1))) for r in rows if r[0] == key)
    return out


def grouped(found):
    out, at = {}, 0
    for r in sorted(found, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
        out.setdefault(r["doc_id"], []).append((r["n_tokens"], r["ids_crc32"]))
    return {k: sorted(v) for k, v in out.items()}


def test_round_trip_of_odd_rows(odd_docs):
    manifest = write_token_store(with_clashes(odd_docs, "key", "start", "row"), default_tokenizer(), 1, shards=4)
    found = scan_token_store(manifest).collect()
    want = expected(odd_rows())
    assert grouped(found) == want
    assert list(dict.fromkeys(r["doc_id"] for r in sorted(found, key=lambda r: r["start"]))) == list(want)


def test_keyed_access(spark, odd_docs):
    manifest = write_token_store(odd_docs, default_tokenizer(), 1, shards=3)
    asked = spark.createDataFrame([(7,), (7,), (4,), (12345,), (None,)], "doc_id long")
    found = sorted(map(tuple, look_up(manifest, asked).collect()))
    stored = sorted(tuple(r) for r in scan_token_store(manifest).collect() if r["doc_id"] in (4, 7))
    assert found == stored and len(found) == 4


def test_empty_table(no_docs):
    assert scan_token_store(write_token_store(no_docs, default_tokenizer(), 1)).count() == 0
