import random
from collections import defaultdict

import pytest

from conftest import SF
from salesflow.llm import ngram_join, tiles
from salesflow.llm.queries import op5_ngram_join

SCHEMA = "doc_id bigint, text string"


def brute(rows, n=5, threshold=0.8):
    """Links and smallest reachable id by comparing all texts."""
    sets = {}
    for key, text in rows:
        words = (text or "").lower().split()
        grams = {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} or ({tuple(words)} if words else set())
        sets[key] = grams
    holders = defaultdict(list)
    for key, grams in sets.items():
        for g in grams:
            holders[g].append(key)
    shared = defaultdict(int)
    for keys in holders.values():
        for i, a in enumerate(keys):
            for b in keys[:i]:
                shared[min(a, b), max(a, b)] += 1
    links, root = defaultdict(int), {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for (a, b), c in shared.items():
        if c >= threshold * (len(sets[a]) + len(sets[b]) - c) - 1e-9:
            links[a] += 1
            links[b] += 1
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {k: (find(k), links[k]) for k in sets}


def got(df):
    return {r.doc_id: (r.class_id, r.n_links) for r in df.collect()}


def test_query_against_brute_force(spark, small):
    assert got(op5_ngram_join(spark, SF)) == brute(small("documents", "doc_id, text"))


@pytest.mark.parametrize("block", [3, 512])
def test_large_group_over_many_tiles(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", block)
    rng = random.Random(3)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for key in range(40):
        words = list(base)
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(120)] = f"x{rng.random()}"
        rows.append((key, " ".join(words)))
    rows += [(100 + k, rows[0][1]) for k in range(20)]  # exact copies
    rows += [(200 + k, " ".join(f"u{k}v{i}" for i in range(30))) for k in range(10)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(ngram_join.join(df)) == brute(rows)


def test_odd_rows(spark, odd):
    rows = ngram_join.join(odd).collect()
    by = {r.doc_id: r for r in rows}
    assert len(rows) == odd.where("doc_id is not null").count()
    assert by[1].n_copies == 2 and by[1].class_id == 1 and by[1].n_links == 1
    for k in (2, 3, 4, 9):
        assert (by[k].class_id, by[k].n_links) == (k, 0)
    assert ngram_join.join(odd.limit(0)).collect() == []


def test_short_texts_link_as_wholes(spark):
    rows = [(1, "a b"), (2, "A  b"), (3, "b a"), (4, "a b c")]
    assert got(ngram_join.join(spark.createDataFrame(rows, SCHEMA))) == {1: (1, 1), 2: (1, 1), 3: (3, 0), 4: (4, 0)}


def test_bands_reach_the_recall():
    for threshold, recall in [(0.8, 0.9999), (0.5, 0.9), (0.9, 0.999)]:
        bands, rows = ngram_join.bands_for(threshold, recall)
        assert bands * rows <= ngram_join.MAX_HASHES
        assert 1 - (1 - threshold**rows) ** bands >= recall


def test_roots_within_a_tile():
    import numpy as np

    ids = np.array([5, 9, 2, 7, 1])
    assert tiles.local_roots(ids, np.array([0, 1]), np.array([1, 2])).tolist() == [2, 2, 2, 7, 1]
