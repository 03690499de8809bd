import zlib

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import SF
from salesflow.llm import bit_packing as B
from salesflow.llm.queries import op9_bit_packing
from salesflow.session import scratch_path

FILE = path("word_bpe_49k.json")


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 32), st.integers(0, 200), st.data())
def test_bits_round_trip(bits, n, data):
    ids = np.random.default_rng(n).integers(0, 1 << bits, n, dtype=np.uint64).astype(np.uint32)
    packed = B.pack_bits(ids, bits)
    assert len(packed) == (n * bits + 7) // 8
    assert B.unpack_bits(packed, bits, n).tolist() == ids.tolist()
    first = data.draw(st.integers(0, n))
    count = data.draw(st.integers(0, n - first))
    assert B.unpack_bits(packed, bits, count, first).tolist() == ids[first : first + count].tolist()


def test_width():
    assert [B.width_of(v) for v in (1, 2, 3, 49_408, 65_536, 65_537)] == [1, 1, 2, 16, 16, 17]


def tie(text):
    """Spark's xxhash64 of a text; a null leaves the seed."""
    value = 42 if text is None else xxhash.xxh64_intdigest(text.encode(), 42)
    return value - (1 << 64) if value >= 1 << 63 else value


def expected(rows, end=2):
    plain = Tokenizer.from_file(FILE)
    at, out = 0, []
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, tie(r[1]), (r[1] or "").encode()))
    for key, text in order:
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, end], "<u4")
        out.append((key, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def key(row):
    return (row[0] is None, row[0] or 0, row[1])


def test_query_against_the_tokenizer(spark, small):
    rows = [tuple(r) for r in op9_bit_packing(spark, SF).collect()]
    assert sorted(rows) == expected(small("documents", "doc_id, text"))


def test_odd_rows_other_widths_and_random_access(spark, odd):
    want = expected([(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()])
    for vocabulary, space in [(49_408, True), (100_000, False)]:
        where = scratch_path(spark, "archive")
        B.write(odd, where, FILE, vocabulary, 2, block_ids=1000, docs_per_file=4, drops_space=space)
        got = B.read(spark, where).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
        assert sorted(map(tuple, got), key=key) == want
        rows = {r.doc_id: r for r in B.read(spark, where, ids=True).collect()}
        assert zlib.crc32(np.array(rows[7]["ids"], "<u4").tobytes()) == rows[7].ids_crc32
        for r in B.files(spark, where).collect():
            file = B.File(bytes(r.content))
            for start, size in zip(file.starts.tolist(), file.sizes.tolist(), strict=True):
                whole = file.ids(start, size)
                assert whole[-1] == 2 and file.ids(start + size // 2, size - size // 2).tolist() == whole[size // 2 :].tolist()


def test_rows_of_one_id_spread_over_files(spark):
    one = spark.range(1200).select(
        F.when(F.col("id") % 3 > 0, F.lit(5)).cast("bigint").alias("doc_id"), F.concat(F.lit("word "), F.col("id")).alias("text")
    )
    where = scratch_path(spark, "archive")
    B.write(one, where, FILE, 49_408, 2, docs_per_file=100, drops_space=True)
    per_file = [r["count"] for r in B.read(spark, where).groupBy("file").count().collect()]
    assert sum(per_file) == 1200 and len(per_file) >= 8 and max(per_file) <= 300
    got = B.read(spark, where).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    want = expected([tuple(r) for r in one.collect()])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_empty_table(spark, odd):
    assert B.round_trip(odd.limit(0), FILE, 49_408, 2).collect() == []
