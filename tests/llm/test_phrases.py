import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF
from oracle_check import compare, connect
from salesflow.llm import phrases
from salesflow.llm.filters import KEY, reaching
from salesflow.llm.oracle import ORACLE
from salesflow.llm.queries import QUERIES

NAME = "op13_collocations"


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute(rows, support, longest=4, top=2000):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower(text or "")):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f[lang].update(tuple(words[s : s + k]) for s in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= support}
        found = []
        for p, a in candidates.items():
            inside = [b for q, b in candidates.items() if len(q) > len(p) and any(q[s : s + len(p)] == p for s in range(len(q) - len(p) + 1))]
            if any(100 * b >= 80 * a for b in inside):
                continue
            score, _, left, right = min(
                (2000000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p))
            )
            found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def made(rng, n):
    rows = []
    for _ in range(n):
        words = [rng.choice(["A", "b", "Cc", "dé", "É", "x1", "the", "of"]) + rng.choice(["", "", ",", ".", "\n", "\t"]) for _ in range(rng.randrange(40))]
        rows.append((rng.choice(["", " "]).join([" ".join(words), ""]), rng.choice(["en", "en", "de", None, "und", ""])))
    return rows


def rows_of(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize(("support", "parts", "top"), [(5, 1, 2000), (12, 7, 2000), (30, 13, 5), (2, 3, 2000)])
def test_against_counting_everything(spark, support, parts, top):
    rows = made(random.Random(support), 200)
    df = spark.createDataFrame(rows, "text string, lang string").repartition(parts)
    assert rows_of(phrases.collocations(df, support=support, top=top)) == brute(rows, support, top=top)


@pytest.mark.parametrize("longest", [1, 2, 3, 5])
def test_other_lengths(spark, longest):
    rows = made(random.Random(longest), 100)
    df = spark.createDataFrame(rows, "text string, lang string").repartition(4)
    assert rows_of(phrases.collocations(df, support=4, longest=longest)) == brute(rows, 4, longest)


def test_small_blocks_and_small_bitmaps_change_nothing(spark, monkeypatch):
    rows = made(random.Random(9), 150)
    df = spark.createDataFrame(rows, "text string, lang string").repartition(5)
    want = brute(rows, 6)
    small = phrases.bitmap
    # So few bits that nearly every phrase passes: the counts by words remove the others.
    monkeypatch.setattr(phrases, "bitmap", lambda df, column: small(df, column, 7))
    monkeypatch.setattr(phrases, "BLOCK_BYTES", 500)
    assert rows_of(phrases.collocations(df, support=6)) == want
    monkeypatch.setattr(phrases, "bitmap", lambda df, column: None)
    assert rows_of(phrases.collocations(df, support=6)) == want


def test_products_pass_64_bits(spark):
    big = 6_000_000_000_000
    data = [("en", 1, "a", big), ("en", 1, "b", big + 1), ("en", 2, "a b", big), ("en", 3, "a b c", big * 8 // 10), ("en", 1, "c", big), ("en", 2, "b c", big)]
    found = spark.createDataFrame(data, "lang string, words int, phrase string, f bigint")
    got = {r.phrase: r.score for r in phrases.outermost(phrases.scored(found)).collect()}
    assert got == {"a b c": 2000000 * (big * 8 // 10) // (2 * big)}


def test_query_equals_sql(spark):
    assert compare(QUERIES[NAME](spark, SF), connect(SF), ORACLE[NAME]) == []


def test_odd_rows(spark, odd):
    assert phrases.collocations(odd.limit(0)).count() == 0
    rows = [(r.text, r.lang) for r in odd.collect()]
    df = odd.withColumn("n", odd.doc_id).withColumn("phrase", odd.text)
    assert rows_of(phrases.collocations(df, support=2)) == brute(rows, 2)


def test_counts_of_a_shard_travel_in_four_bytes_and_add_up_over_tasks(spark):
    rng = random.Random(9)
    rows = [(" ".join(f"w{rng.randrange(300)}" for _ in range(400)), "en") for _ in range(60)]
    df = spark.createDataFrame(rows, "text string, lang string")
    first, last = df.repartition(1).limit(30), df.repartition(1).limit(30)
    packed = phrases._local(first, (2,), phrases._everything, 3).union(phrases._local(last, (2,), phrases._everything, 3))
    sent = packed.select(F.sum(F.length("keys") + F.length("counts")), F.sum(F.length("counts"))).first()
    assert sent[0] == 4 * sent[1] > 0
    # Both halves are the same rows in shard 0, so pairs met twice in either have four occurrences.
    counts = Counter()
    for text, lang in first.collect():
        block = phrases.Block(pa.array([text]).cast(pa.large_string()), pa.array([lang]))
        counts.update((block.grams(2)[1] & KEY).tolist())
    got = [r.hash for r in reaching(packed, 3).collect()]
    assert sorted(got) == sorted(k for k, n in counts.items() if 2 * min(n, 3) >= 3)
    assert 0 < len(got) < len(counts)


def test_many_occurrences_wanted(spark):
    df = spark.createDataFrame([("a b " * 900, "en"), ("a b. " * 100, "en")], "text string, lang string")
    got = rows_of(phrases.collocations(df, support=1000))
    assert got == rows_of(phrases.collocations(df.repartition(5), support=1000))
    assert [(r[2], r[3]) for r in got] == [("a b", 1000)]
