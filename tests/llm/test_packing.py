import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import path
from tokenizers import Tokenizer

from conftest import SF
from salesflow.llm.packing import SumOfSquares, pack, sequences
from salesflow.llm.queries import op4_packing


def slow_level(counts, size, window):
    """The rule by its definition: the sum of squares after each possible placement."""
    best = None
    for h in range(window - size, -1, -1):
        if h and not counts[h]:
            continue
        after = counts.copy()
        if h:
            after[h] -= 1
        if h + size < window:
            after[h + size] += 1
        key = (after[1:window] ** 2).sum()
        if best is None or key < best[0]:
            best = (key, h)
    return best[1]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 16), max_size=60))
def test_each_placement_minimises_the_sum_of_squares(sizes):
    state = SumOfSquares(16)
    for size in sizes:
        assert state.level(size) == slow_level(state.counts.astype(int), size, 16)
        state.place(("d", 0, np.zeros(size), size), size)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 70), max_size=40))
def test_every_id_is_in_one_piece_and_nothing_needs_padding(sizes):
    docs = [(k, np.arange(n, dtype=np.uint32)) for k, n in enumerate(sizes)]
    seen = {k: [] for k, _ in docs}
    for sequence in sequences(iter(docs), 16):
        fill = sum(len(p[2]) for p in sequence)
        assert fill == 16 or fill & (fill - 1) == 0
        for key, at, ids, total in sequence:
            assert total == sizes[key] and ids[0] == at
            seen[key].extend(ids.tolist())
    assert all(sorted(seen[k]) == list(range(n)) for k, n in enumerate(sizes))


def check(rows, ids):
    covered = {}
    fills = {}
    for r in rows:
        own = ids[r.doc_id]
        assert r.doc_tokens == len(own)
        assert zlib.crc32(own[r.start : r.start + r.length].tobytes()) == r.ids_crc32
        covered[r.doc_id] = covered.get(r.doc_id, 0) + r.length
        fills.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in fills.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    return covered


def encoded(texts):
    plain = Tokenizer.from_file(path("byte_bpe_50k.json"))
    return {k: np.array([*plain.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for k, t in texts}


def test_query_against_the_tokenizer(spark, small):
    ids = encoded(small("documents", "doc_id, text"))
    assert check(op4_packing(spark, SF).collect(), ids) == {k: len(v) for k, v in ids.items()}


def test_odd_rows(spark, odd):
    file = path("byte_bpe_50k.json")
    rows = pack(odd, file, 1).collect()
    texts = {r.doc_id: r.text for r in odd.collect()}
    ids = encoded(texts.items())
    covered = check(rows, ids)
    times = {1: 2}
    assert covered == {k: len(v) * times.get(k, 1) for k, v in ids.items()}
    assert pack(odd.limit(0), file, 1).count() == 0
    pieces = pack(odd, file, 1, ids=True).where("doc_id = 8").orderBy("start").collect()
    assert [i for p in pieces for i in p["ids"]] == ids[8].tolist()


@pytest.mark.parametrize("parts", [1, 7])
def test_sequences_are_told_apart_over_partitions(spark, odd, parts):
    rows = pack(odd.repartition(parts), path("byte_bpe_50k.json"), 1).collect()
    check(rows, encoded({r.doc_id: r.text for r in odd.collect()}.items()))
