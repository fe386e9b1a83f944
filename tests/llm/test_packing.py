import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from commitlens.llm.packing import (
    Places,
    _best_fit,
    pack,
    plan_sequences,
    round_configurations,
    solve_configurations,
    solve_program,
    volume_bound,
)
from commitlens.llm.tokens import TextEncoder, default_tokenizer
from tests.llm.conftest import odd_rows, with_clashes


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=20))
def test_plan_holds_every_piece_once(counts):
    plan = plan_sequences(counts, 64)
    held = Counter()
    for lengths, n in plan.items():
        assert sum(lengths) <= 64 and n > 0
        for x in lengths:
            held[x] += n
    assert held == Counter(counts)
    places = Places(plan)
    length = np.repeat(np.array(list(counts), np.int64), list(counts.values()))
    rank = np.concatenate([np.arange(n) for n in counts.values()]) if counts else length
    sequence, offset = places.of(length, rank) if counts else (rank, rank)
    for s in set(sequence.tolist()):
        at = np.flatnonzero(sequence == s)
        at = at[np.argsort(offset[at])]
        assert offset[at].tolist() == (np.cumsum(length[at]) - length[at]).tolist()


def test_plan_is_close_to_the_bound():
    rng = np.random.default_rng(3)
    for make in (lambda: rng.integers(1, 2049, 3000), lambda: np.minimum(2048, rng.lognormal(6, 1, 5000).astype(int) + 1)):
        lengths = make()
        plan = plan_sequences(dict(Counter(lengths.tolist())), 2048)
        assert plan.total() <= -(-int(lengths.sum()) // 2048) * 1.01 + 1


def test_plan_finds_exact_fits():
    # Best fit, longest first, opens 7 sequences for the second histogram.
    assert plan_sequences({1024: 7, 2048: 2}, 2048).total() == 6
    assert plan_sequences({6: 4, 5: 4, 9: 4}, 20).total() == 4


def few_lengths():
    rng = np.random.default_rng(3)
    lengths = rng.choice(np.arange(300, 1100), 40, False)
    return dict(zip(lengths.tolist(), rng.integers(10, 500, 40).tolist()))


def test_program_saves_sequences_where_the_volume_bound_is_loose():
    few = {1030: 400, 1018: 400, 700: 500, 690: 500, 650: 700, 512: 300, 500: 600, 340: 500}
    for counts, most in ((few_lengths(), 3700), (few, 1280)):
        first = round_configurations(solve_configurations(counts, 2048), counts, 2048).total()
        assert plan_sequences(counts, 2048).total() <= most < first


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), min_size=1, max_size=8))
def test_program_covers_and_its_bound_holds(counts):
    solution, bound = solve_program(counts, 40, rounds=200)
    held = Counter()
    for lengths, amount in solution:
        assert sum(lengths) <= 40 and amount > 0
        for x in lengths:
            held[x] += amount
    assert all(held[x] >= n * (1 - 1e-9) for x, n in counts.items())
    total = sum(amount for _, amount in solution)
    assert bound <= total * (1 + 1e-9)
    # No packing has fewer sequences, nor has any fewer than the volume.
    assert volume_bound(counts, 40) - 1 < bound <= plan_sequences(counts, 40).total() + 1e-9


def test_no_pieces_at_all():
    assert solve_program({}, 2048) == ([], 0.0) and plan_sequences({}, 2048) == Counter()


def check_pieces(found, rows, capacity):
    encode, want = TextEncoder(default_tokenizer()), Counter()
    for row in rows:
        ids = encode.encode([row[1]])[0] + (0).to_bytes(4, "little")
        for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
            part = ids[at : at + 4 * capacity]
            want[row[0], piece, at // 4, len(part) // 4, zlib.crc32(part)] += 1
    got = Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found)
    assert got == want
    sequences = {}
    for r in found:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity


def test_pieces_of_odd_rows(odd_docs):
    found = pack(with_clashes(odd_docs, "key", "rank", "task", "length"), default_tokenizer(), 0).collect()
    check_pieces(found, odd_rows(), 2048)


def test_pieces_of_documents(documents):
    found = pack(documents, default_tokenizer(), 0, capacity=256).collect()
    check_pieces(found, [tuple(r) for r in documents.select("doc_id", "text").collect()], 256)
    best_fit = _best_fit(dict(Counter(r["length"] for r in found)), Counter(), 256)
    assert len({r["sequence_id"] for r in found}) <= best_fit.total()


def test_empty_table(no_docs):
    assert pack(no_docs, default_tokenizer(), 0).count() == 0


def test_plan_of_documents_meets_the_bound(documents):
    found = pack(documents, default_tokenizer(), 0).collect()
    bound = volume_bound(dict(Counter(r["length"] for r in found)), 2048)
    assert bound <= len({r["sequence_id"] for r in found}) <= bound * 1.005 + 1


def test_every_plan_comes_from_the_program(monkeypatch):
    from commitlens.llm import packing

    asked = []

    def program(counts, capacity):
        asked.append(counts)
        return solve_program(counts, capacity)

    monkeypatch.setattr(packing, "solve_program", program)
    # A volume bound that is met at once is no way past it.
    assert plan_sequences({32: 8}, 64).total() == 4 and asked == [{32: 8}]
