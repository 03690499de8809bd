import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF
from oracle_check import compare, connect
from salesflow.llm import substring
from salesflow.llm.oracle import ORACLE
from salesflow.llm.queries import QUERIES

NAME = "op12_substring_dedup"


def brute(texts, length):
    docs = [(t or "").encode().split() for t in texts]
    count = Counter(tuple(d[s : s + length]) for d in docs for s in range(len(d) - length + 1))
    out = []
    for d in docs:
        gone = set()
        for s in range(len(d) - length + 1):
            if count[tuple(d[s : s + length])] > 1:
                gone.update(range(s, s + length))
        out.append((len(d), len(gone), b" ".join(w for i, w in enumerate(d) if i not in gone).decode()))
    return out


def cleaned(spark, texts, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(3)
    rows = substring.remove(df, **options).collect()
    return [(r.n_words, r.n_removed, r.kept) for r in sorted(rows)]


def made(rng, n, types=30):
    """Texts with shared passages, repeats inside a text, near copies and runs of one word."""
    word = lambda: f"w{rng.randrange(types)}"
    shared = [[word() for _ in range(rng.choice([5, 6, 7, 20, 60]))] for _ in range(6)]
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randrange(4)):
            parts += rng.choice([[word() for _ in range(rng.randrange(25))], rng.choice(shared), ["again"] * rng.randrange(12)])
        if rng.random() < 0.2 and texts:
            parts = rng.choice(texts).split()
            if parts:
                parts[rng.randrange(len(parts))] = word()
        texts.append(rng.choice([" ", "\n", " \t"]).join(parts))
    return texts


@pytest.mark.parametrize(("length", "seed"), [(6, 1), (1, 2), (35, 3), (24, 4)])
def test_against_counting_all_windows(spark, length, seed):
    texts = made(random.Random(seed), 80)
    assert cleaned(spark, texts, length=length) == brute(texts, length)


def test_hot_anchors_go_by_windows(spark):
    # One passage in many texts, each with other words around it.
    rng = random.Random(5)
    hot = [f"h{k}" for k in range(8)]
    texts = [" ".join([f"a{rng.randrange(9)}" for _ in range(9)] + hot + [f"b{rng.randrange(9)}" for _ in range(9)]) for _ in range(120)]
    want = brute(texts, 8)
    assert cleaned(spark, texts, length=8, most_passages=1) == want
    assert cleaned(spark, texts, length=8) == want


def test_shards_end_between_anchors(spark, monkeypatch):
    monkeypatch.setattr(substring, "SHARD_WORDS", 10)
    texts = made(random.Random(6), 60)
    assert cleaned(spark, texts, length=6) == brute(texts, 6)


def test_without_bitmaps(spark, monkeypatch):
    # As where there are too many anchors and copies for them.
    monkeypatch.setattr(substring, "bitmap", lambda df, column: None)
    texts = made(random.Random(9), 60)
    texts += texts[:5]
    assert cleaned(spark, texts, length=6) == brute(texts, 6)


def test_automaton_counts_places():
    rng = random.Random(7)
    sequences = [([rng.randrange(3) for _ in range(rng.randrange(1, 12))], rng.randrange(1, 3)) for _ in range(12)]
    automaton = substring.Automaton(sequences)

    def places(run):
        return sum(w for s, w in sequences for k in range(len(s) - len(run) + 1) if s[k : k + len(run)] == run)

    for s, _ in sequences:
        for k, n in enumerate(automaton.statistics(s)):
            longest = max((m for m in range(1, k + 2) if places(s[k + 1 - m : k + 1]) >= 2), default=0)
            assert n == longest
    assert automaton.statistics([9, 9]) == [0, 0]


def test_segments_do_not_matter(monkeypatch):
    rng = random.Random(8)
    column = pa.array([" ".join(f"w{rng.randrange(5)}" for _ in range(500)), "", None, " ".join(["one"] * 90)])
    windows = []
    for segment in (1 << 22, 64):
        monkeypatch.setattr(substring, "_SEGMENT", segment)
        found = substring.Passages(column, 35)
        each = [(t, s + k, a) for t, s, n, a in zip(found.text, found.start, found.windows, found.anchor, strict=True) for k in range(n)]
        windows.append(each)
        assert len(each) == 466 + 56
    assert windows[0] == windows[1]


def test_query_equals_sql(spark):
    assert compare(QUERIES[NAME](spark, SF), connect(SF), ORACLE[NAME]) == []


def test_odd_rows(spark, odd):
    df = odd.withColumn("kept", odd.text)
    got = substring.remove(df)
    assert got.columns == [*df.columns, "n_words", "n_removed", "_cut_kept"]
    rows = got.collect()
    assert len(rows) == 11
    of = {r.doc_id: (r.n_words, r.n_removed, r._cut_kept) for r in rows}
    assert of[2] == of[3] == of[4] == (0, 0, "")
    assert of[1] == (8, 0, "One two three four five six seven eight.")
    assert of[7] == (120_000, 120_000, "")
    assert of[5] == (3, 0, "12 34 !?")
    assert substring.remove(df.limit(0)).count() == 0


def test_repeated_rows_are_other_places(spark):
    text = " ".join(f"w{k}" for k in range(40))
    df = spark.createDataFrame([(1, text), (1, text), (None, text + " end"), (2, "w1 w2")], "doc_id int, text string")
    got = sorted((r.n_words, r.n_removed) for r in substring.remove(df).collect())
    assert got == [(2, 0), (40, 40), (40, 40), (41, 40)]


def test_of_equal_texts_one_copy_is_fetched_as_words(spark):
    text = "  ".join(f"word{k}" for k in range(90))
    docs = spark.createDataFrame([(text,)] * 40 + [("some other text",)], "text string").repartition(5)
    docs = docs.select(F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"), "text")
    found = substring.Passages(pa.array([text]), 35)
    at = docs.where(F.length("text") > 50).select("h1", "h2").first()
    starts = [(at.h1, at.h2, int(s)) for s in found.start]
    reference = spark.createDataFrame(starts, "h1 bigint, h2 bigint, start int")
    rows = substring._contents(substring._distinct(docs), reference, None, 35).collect()
    spans = zip(found.begin.tolist(), found.end.tolist(), strict=True)
    assert sorted(bytes(r.words) for r in rows) == sorted(" ".join(text.split()[a:b]).encode() for a, b in spans)


def test_texts_that_lose_nothing_are_not_shuffled(spark):
    shared = " ".join(f"s{k}" for k in range(40))
    texts = [" ".join(f"t{n}w{k}" for k in range(60)) for n in range(50)] + [shared, shared]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    cleaned = substring.remove(df)
    assert sorted(tuple(r)[1:] for r in cleaned.select("id", "n_words", "n_removed").collect()) == sorted([(60, 0)] * 50 + [(40, 40)] * 2)
    plan = cleaned._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and plan.count("Join") == 1
