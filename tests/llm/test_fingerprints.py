import hashlib

import pytest
import xxhash

from conftest import SF
from salesflow.llm import fingerprints as P
from salesflow.llm.queries import op3_fingerprints

SCHEMA = "doc_id bigint, text string"


def signed(value):
    return value - (1 << 64) if value >= 1 << 63 else value


def spark_hash(data: bytes, seed=42):
    """xxhash64 of Spark, as a signed number."""
    return signed(xxhash.xxh64_intdigest(data, seed))


def words(text):
    import regex

    return {w for w in regex.split(r"[^\p{L}\p{N}]+", text.lower()) if w}


def brute(texts):
    """Fingerprints by definition, from (id, text) rows; also of the edited texts."""
    from collections import Counter

    df = Counter(w for _, t in texts for w in words(t))
    low = max(P.LEAST_DOCUMENTS, P.LEAST_SHARE * len(texts))
    high = max(low, P.MOST_SHARE * len(texts))
    band = {w for w, n in df.items() if low <= n <= high}
    term = {w: spark_hash(w.encode()) for w in band}

    def again(value, salt):
        # A hash of several columns takes the one so far as its seed.
        seed = xxhash.xxh64_intdigest((value & (1 << 64) - 1).to_bytes(8, "little"), 42)
        data = salt.encode() if isinstance(salt, str) else salt.to_bytes(4, "little")
        return xxhash.xxh64_intdigest(data, seed)

    member = {w: [again(h, k) & ((1 << level) - 1) == 0 for k, level in enumerate(P.SUBSETS)] for w, h in term.items()}
    mark = {w: (1 << 42) + (again(h, "mark") >> 26) for w, h in term.items()}

    def fingerprint(text):
        own = words(text) & band
        parts = []
        for k in range(len(P.SUBSETS)):
            hits = [mark[w] for w in own if member[w][k]]
            parts.append(format(sum(hits), "x") if hits and sum(hits) >> 42 <= P.MOST_TERMS else "-")
        if set(parts) == {"-"}:
            return "text:" + format(spark_hash(text.encode()) & (1 << 64) - 1, "x")
        return ".".join(parts)

    return fingerprint


def like(a, b):
    if a == b:
        return 1.0
    pairs = [(x, y) for x, y in zip(a.split("."), b.split("."), strict=False) if x != "-" or y != "-"]
    return sum(x == y for x, y in pairs) / len(pairs) if pairs else 0.0


def expected(rows):
    """By id: n_chars, sha of the edited text, both fingerprints, both likenesses."""
    texts = [(k, t or "") for k, t in rows]
    fp = brute(texts)
    out = {}
    for k, (key, text) in enumerate(texts):
        after = texts[(k + 1) % len(texts)][1]
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + after[:quarter]
        own, changed = fp(text), fp(edited)
        row = (len(text), hashlib.sha256(edited.encode()).hexdigest(), own, changed, like(own, changed), like(own, fp(after)))
        out.setdefault(key, []).append(row)
    return out


def got(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.doc_id, []).append(tuple(r)[1:])
    return out


def same(a, b):
    assert a.keys() == b.keys()
    for k in a:
        for x, y in zip(sorted(a[k]), sorted(b[k]), strict=True):
            assert x[:4] == y[:4] and x[4:] == pytest.approx(y[4:])


def test_query_against_brute_force(spark, small):
    same(got(op3_fingerprints(spark, SF)), expected(small("documents", "doc_id, text")))


def test_edits_stay_closer_than_neighbours(spark):
    df = op3_fingerprints(spark, "/root/testdata/sf0.01").toPandas()
    assert df.near_edited.mean() > 0.3 and df.near_next.mean() < 0.02


@pytest.mark.parametrize("per_range", [1, 3, 100])
def test_next_over_ranges(spark, odd, per_range):
    rows = sorted(
        [(r.doc_id, r.text or "") for r in odd.collect()], key=lambda r: (r[0] is None, r[0] or 0, r[1])
    )
    out = P.with_next(odd, "doc_id", "text", per_range).collect()
    assert sorted((r.id is None, r.id or 0, r.text, r.next_text) for r in out) == sorted(
        (k is None, k or 0, t, rows[(n + 1) % len(rows)][1]) for n, (k, t) in enumerate(rows)
    )
    places = {tuple(r["at"]): r.text for r in out}
    assert len(places) == len(rows) and all(places[tuple(r.next_at)] == r.next_text for r in out)


def test_odd_tables(spark, odd):
    out = P.compared(odd).collect()
    assert len(out) == odd.count()
    twins = {r.fingerprint for r in out if r.doc_id in (1, None)}
    assert len(twins) == 1
    assert P.compared(odd.limit(0)).collect() == []
    nameless = P.compared(odd.selectExpr("cast(null as bigint) as doc_id", "text"))
    assert nameless.count() == odd.count()
    alone = P.compared(spark.createDataFrame([(1, "a b c d")], SCHEMA)).first()
    assert alone.near_next == 1.0 and alone.edited_sha256 == hashlib.sha256(b"a b c a").hexdigest()


@pytest.mark.parametrize("salt", ["a", "b", "c"])
def test_near_copies_of_very_long_texts(spark, salt):
    terms = [f"{salt}{n}" for n in range(100_000)]
    edited = [f"other{n}" if n % 1000 == 0 else t for n, t in enumerate(terms)]
    df = spark.createDataFrame([(1, " ".join(terms)), (2, " ".join(edited)), (3, "short text")], SCHEMA)
    found = {r.doc_id: r.fingerprint for r in P.fingerprints(df, P.lexicon(df), ["doc_id"], {"own": "text"}).collect()}
    # Only the shared terms are in the band, so both have the same ones.
    assert not found[1].startswith("text:") and found[1] == found[2]
    wide = P.lexicon(df, least=1, most_share=1.0)
    own = {r.doc_id: r.fingerprint for r in P.fingerprints(df, wide, ["doc_id"], {"own": "text"}).collect()}
    assert not own[1].startswith("text:") and like(own[1], own[2]) > 0.3
