import duckdb
import numpy as np

from conftest import SF
from salesflow.llm import lattice as L
from salesflow.llm.queries import op10_lattice_dedup

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(ids, vectors, threshold=0.95):
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    close = unit @ unit.T >= threshold
    np.fill_diagonal(close, False)
    root = np.array(ids)
    while True:
        new = np.array([min([root[k], *root[close[k]]]) for k in range(len(ids))])
        if (new == root).all():
            break
        root = new
    return {i: (int(n), int(r)) for i, n, r in zip(ids, close.sum(1), root, strict=True)}


def got(df):
    return {r.vec_id: (r.n_links, r.component_id) for r in df.collect()}


def planted(seed=2, n=300, d=32):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n, d))
    near = base[:60] + 0.22 * rng.standard_normal((60, d))
    group = base[5] + 0.05 * rng.standard_normal((80, d))
    return np.vstack([base, near, group, base[7:9], base[7:9]]).astype(np.float32)


def test_recall_and_no_false_link(spark):
    v = planted()
    ids = list(range(len(v)))
    df = spark.createDataFrame([(i, x.tolist(), 0) for i, x in zip(ids, v, strict=True)], SCHEMA)
    want, found = brute(ids, v.astype(float)), got(L.near_duplicates(df))
    total = sum(n for n, _ in want.values())
    assert all(found[i][0] <= want[i][0] for i in ids)
    assert sum(n for n, _ in found.values()) >= 0.98 * total


def test_plans_find_pairs_at_the_threshold():
    rng = np.random.default_rng(4)
    a = rng.standard_normal((4000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    z = rng.standard_normal((4000, 64))
    z -= (z * a).sum(1, keepdims=True) * a
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    shares = []
    for _, plan in L.PLANS:
        one = L.cells(a, *plan)
        for cosine in (0.95, 0.0):
            two = L.cells(cosine * a + np.sqrt(1 - cosine**2) * z, *plan)
            shares.append(np.mean([len(np.intersect1d(x, y)) > 0 for x, y in zip(one, two, strict=True)]))
    assert min(shares[::2]) >= 0.99 and max(shares[1::2]) <= 0.01


def test_longer_codes_find_the_same_links(spark):
    v = planted()
    df = spark.createDataFrame([(i, x.tolist(), 0) for i, x in enumerate(v)], SCHEMA)
    assert got(L.near_duplicates(df, plan=L.PLANS[1][1])) == brute(list(range(len(v))), v.astype(float))


def test_query_against_brute_force(spark):
    rows = duckdb.sql(f"select vec_id, embedding from '{SF}/embeddings.parquet'").fetchall()
    want = brute([r[0] for r in rows], np.array([r[1] for r in rows]))
    assert got(op10_lattice_dedup(spark, SF)) == want


def test_odd_rows(spark):
    one = [1.0, 2.0, 3.0]
    rows = [
        (1, one, 0), (2, one, None), (2, one, 1), (3, None, 0), (4, [0.0, 0.0, 0.0], 0),
        (5, [1.0, None, 3.0], 0), (6, [float("nan"), 1.0, 1.0], 0), (7, [float("inf"), 1.0, 1.0], 0),
        (8, [], 0), (None, one, 0), (9, [2.0, 4.0, 6.0], 0), (10, [1.0, 2.0], 0),
        (11, [1e-30, 2e-30, 3e-30], 0), (12, [1e38, 2e38, 3e38], 0),
    ]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as kept", "2 as copies", "'k' as key")
    out = L.near_duplicates(df).collect()
    assert len(out) == len(rows)
    by = {}
    for r in out:
        by.setdefault(r.vec_id, []).append((r.n_links, r.component_id, r.kept))
    assert by[1] == [(5, 1, True)] and by[2] == [(5, 1, False)] * 2 and by[9] == by[11] == by[12] == [(5, 1, False)]
    for k in (3, 4, 5, 6, 7, 8, 10):
        assert by[k] == [(0, k, True)]
    assert by[None] == [(0, None, True)]
    assert L.near_duplicates(df.limit(0)).collect() == []


def test_roots_and_decoding():
    assert len(L.ROOTS) == 240 and np.allclose((L.ROOTS**2).sum(1), 2)
    rng = np.random.default_rng(0)
    y = rng.uniform(-2, 2, (200, 8))
    x = L.decode(y)
    twice = np.rint(2 * x)
    assert np.allclose(twice, 2 * x) and ((twice % 2).sum(1) % 8 == 0).all() and (np.rint(x.sum(1)) % 2 == 0).all()
    # No neighbour lies closer.
    gap = ((y - x) ** 2).sum(1)
    assert all((((y[k] - x[k] - L.ROOTS) ** 2).sum(1) >= gap[k] - 1e-9).all() for k in range(len(y)))
    assert np.allclose(x[:5], L.decode(x[:5]))


def test_links_do_not_depend_on_the_number_of_rows(spark, monkeypatch):
    v = planted()
    df = spark.createDataFrame([(i, x.tolist(), 0) for i, x in enumerate(v)], SCHEMA)
    used = []
    for most in (1, 10**9):
        # On either side of a limit below which a plan would find little.
        monkeypatch.setattr(L, "PLANS", ((most, (1, 1, 0, 0.05)), *L.PLANS[1:]))
        used.append(got(L.near_duplicates(df)))
    assert used[0] == used[1] == got(L.near_duplicates(df, plan=L.PLANS[1][1]))
