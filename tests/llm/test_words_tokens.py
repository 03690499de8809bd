import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from salesflow.llm import words
from salesflow.llm.bpe import Encoder, WordTable
from salesflow.llm.packing import ByteBpe

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [
    "", " ", "a  b", " a", "a ", "a\n b", "<|endoftext|> x", "x<|endoftext|>y", "\t a", "É 's b 't",
    "a\x1cb c", "x\0y z", "a\x0bb\x0c c", "İ x", "\nab", "ab\ncd ef", "́ ́a b", "a b c　d 12 345", "á e",
]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_remembered_words_give_the_tokenizer_s_ids(name, small):
    path = public_tokenizers.path(name)
    plain, ours = Tokenizer.from_file(path), Encoder(path)
    texts = ODD + [t or "" for _, t in small("documents", "doc_id, text")]
    for _ in range(2):
        for text, ids in zip(texts, ours.encode(texts), strict=True):
            assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids


def test_byte_bpe_gives_the_tokenizer_s_ids(small):
    path = public_tokenizers.path("byte_bpe_50k.json")
    plain, ours = Tokenizer.from_file(path), ByteBpe(path)
    for text in ODD + [t or "" for _, t in small("documents", "doc_id, text")]:
        assert ours.encode(text).tolist() == plain.encode(text, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aBé \n\t\x0b　z", max_size=40)), max_size=8))
def test_words_are_split_hashed_and_bounded(texts):
    old, words.BLOCK_BYTES = words.BLOCK_BYTES, 7
    try:
        hashes, bounds = words.word_hashes(pa.array(texts, pa.string()))
    finally:
        words.BLOCK_BYTES = old
    table = str.maketrans("B", "b")
    split = [WORD.findall((t or "").translate(table)) for t in texts]
    assert np.diff(bounds).tolist() == [len(s) for s in split]
    flat = [w for s in split for w in s]
    names = {}
    for w, h in zip(flat, hashes.tolist(), strict=True):
        assert names.setdefault(w, h) == h == words.hash_word(w)
    assert len(set(names.values())) == len(names)


def test_a_slice_of_a_batch_reads_its_own_rows():
    column = pa.array(["x y", "a b c", None, "d"]).slice(1, 2)
    hashes, bounds = words.word_hashes(column)
    assert bounds.tolist() == [0, 3, 3] and hashes[1] == words.hash_word("b")


def test_word_table_gives_the_tokenizer_s_ids(small):
    path = public_tokenizers.path("word_bpe_49k.json")
    plain, ours = Tokenizer.from_file(path), WordTable(path)
    texts = ODD + [t or "" for _, t in small("documents", "doc_id, text")]
    for _ in range(2):
        ids, bounds = ours.encode(pa.array([*texts, None]))
        for k, text in enumerate([*texts, ""]):
            want = plain.encode(text, add_special_tokens=False).ids
            assert ids[bounds[k] : bounds[k + 1]].tolist() == want


def test_lookup_finds_all_and_nothing_else():
    rng = np.random.default_rng(5)
    known = np.unique(rng.integers(0, 1 << 63, 5000, dtype=np.uint64) * np.uint64(2))
    table = words.Lookup(rng.permutation(known))
    assert table.find(known).tolist() == list(range(len(known)))
    assert (table.find(known + np.uint64(1)) == -1).all()
    assert words.Lookup(known[:0]).find(known[:3]).tolist() == [-1, -1, -1]
