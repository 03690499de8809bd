import zlib

import numpy as np
import pytest
from public_tokenizers import path
from tokenizers import Tokenizer

import corpus_pipeline as C
from conftest import SF
from test_mixing import fill
from test_ngram_join import brute


def test_stages():
    assert [n for n, _ in C.STAGES] == ["language_id", "ngram_join", "mix_sources", "packing"]


def test_every_stage_on_its_own_input(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    schema = docs.schema
    kept = C.languages(spark, docs, SF)
    assert kept.schema == schema and kept.count() == docs.where(r"text rlike '\\p{L}'").count()
    single = C.deduplicated(spark, kept, SF)
    assert single.schema == schema
    links = brute([(r.doc_id, r.text) for r in kept.collect()])
    assert sorted(r.doc_id for r in single.collect()) == sorted(k for k, (root, _) in links.items() if root == k)
    mix = C.mixed(spark, single, SF)
    assert mix.schema == schema
    times = {}
    for r in mix.collect():
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    assert max(times.values()) <= 2 and set(times) <= {r.doc_id for r in single.collect()}
    plain = Tokenizer.from_file(path("byte_bpe_50k.json"))
    pieces = C.packed(spark, mix, SF).collect()
    texts = {r.doc_id: r.text for r in single.collect()}
    length = dict.fromkeys(times, 0)
    for p in pieces:
        ids = np.array([*plain.encode(texts[p.doc_id], add_special_tokens=False).ids, 1], "<u4")
        assert zlib.crc32(ids[p.start : p.start + p.length].tobytes()) == p.ids_crc32
        length[p.doc_id] += p.length
        assert p.doc_tokens == len(ids)
    own = {p.doc_id: p.doc_tokens for p in pieces}
    assert length == {k: n * own[k] for k, n in times.items()}


def test_run_repeats_itself(spark):
    key = ["doc_id", "start", "length", "ids_crc32", "sequence_id", "offset"]
    first, second = (
        C.run(spark, SF).drop("sequence_id", "offset").groupBy("doc_id").sum("length").collect() for _ in range(2)
    )
    assert sorted(first) == sorted(second) and len(first) > 100 and len(key) == 6


@pytest.mark.parametrize("empty", [False, True])
def test_odd_documents_pass_all_stages(spark, odd, empty):
    docs = odd.select("doc_id", "text", "lang", "source", "n_chars", "copies", "score", "target")
    docs = docs.limit(0) if empty else docs
    for k, (_, stage) in enumerate(C.STAGES):
        out = stage(spark, docs, SF)
        if k < 3:
            assert out.columns == docs.columns
        rows = out.collect()
        docs = spark.createDataFrame(rows, out.schema)
    if empty:
        assert rows == []
        return
    ids = {r.doc_id for r in rows}
    assert ids <= {1, 6, 7, 8, None} and 7 in ids | {1, 6, 8}


def test_null_and_shared_ids_are_compared(spark, odd):
    rows = C.deduplicated(spark, odd, SF).collect()
    assert sorted(r.doc_id for r in rows) == [1, 2, 3, 4, 5, 6, 7, 8, 9]
    assert fill([1], [5], 1.5, 2.0) == [1.5]
    text = " ".join(f"word{k}" for k in range(40))
    near, other = text + " more", " ".join(f"other{k}" for k in range(40))
    data = [(None, text)] * 3 + [(None, near), (7, near), (7, text), (7, other), (None, other + " x"), (None, None), (None, "")]
    df = spark.createDataFrame(data, "doc_id bigint, text string")
    kept = sorted(C.deduplicated(spark, df, SF).collect(), key=repr)
    texts = [r.text for r in kept if r.doc_id == 7]
    assert len(texts) == 2 and other in texts and (text in texts or near in texts)
    assert sorted(repr(r.text) for r in kept if r.doc_id is None) == ["''", "None"]
