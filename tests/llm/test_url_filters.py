import numpy as np
from oracle_check import compare, connect

from conftest import SF
from salesflow.llm import url_filters as U
from salesflow.llm.oracle import ORACLE
from salesflow.llm.queries import URL_RULES, op8_url_filters

SCHEMA = "page_id bigint, url string, html string"


def test_query_equals_sql(spark):
    assert compare(op8_url_filters(spark, SF), connect(SF), ORACLE["op8_url_filters"]) == []


def linked(spark):
    def page(key, url, *to):
        return (key, url, "".join(f"<a HREF = '{t}'>x</a>" for t in to))

    rows = [
        page(1, "http://good.org/fr/1", "http://fine.com/a", "//Fine.com/b", "https://mid.com"),
        page(2, "http://bad.net/x", "http://good.org/fr/"),
        page(3, "http://spam.com/1", "http://bad.net/y", "http://bad.net/z"),
        page(4, "http://fine.com/a", "http://mid.com/?q"),
        page(5, "http://mid.com/a", "http://bad.net/", "http://fine.com", "http://fine.com/2"),
        page(6, "http://alone.com/1", "/relative", "#x"),
        page(7, "http://far.com/1", "http://spam.com/"),
        page(8, None, "http://bad.net/"),
        page(9, "nothing", "http://bad.net/"),
        (10, "HTTPS://A.Example.NET/en/x", None),
        (11, "http://example.com?de/", ""),
        (12, "http://www.example.com/de/x#y", None),
        (None, "http://notexample.com/de/", None),
        (12, "http://www.example.com/de/x#y", None),
    ]
    return spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as host", "'y' as rule", "1 as trust")


def test_rules_and_odd_rows(spark):
    out = U.judge(linked(spark), URL_RULES).collect()
    assert len(out) == 14
    by = {r.page_id: r for r in out}
    assert (by[10].host, by[10].path, by[10].rule, by[10].verdict) == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert (by[11].host, by[11].path, by[11].rule) == ("example.com", "", None)
    assert by[12].rule == "example.com/de/" and by[12].verdict == "block"
    assert by[None].rule is None and by[2].rule == "net/" and by[1].rule == "org/fr/"
    for k in (8, 9):
        assert (by[k].host, by[k].path, by[k].rule, by[k].verdict) == ("", "", None, "allow")
    assert by[3].verdict == by[7].verdict == "block" and by[4].verdict == by[6].verdict == "allow"
    assert U.judge(linked(spark).limit(0), URL_RULES).collect() == []


def test_ranks_against_matrices(spark):
    df = linked(spark)
    edges = {(r.source, r.target): r.n for r in U.links(df).collect()}
    assert edges[("good.org", "fine.com")] == 2 and ("alone.com", "") not in edges
    hosts = sorted({h for e in edges for h in e} | {"www.example.com"})
    at = {h: k for k, h in enumerate(hosts)}
    seeds = {"trust": ["good.org"], "distrust": ["bad.net", "www.example.com"]}
    rows = [(h, k, 1.0) for k, hs in seeds.items() for h in hs]
    got = U.propagate(U.links(df), spark.createDataFrame(rows, "host string, kind string, seed double")).collect()
    for kind, hs in seeds.items():
        m = np.zeros((len(hosts), len(hosts)))
        for (a, b), n in edges.items():
            a, b = (a, b) if kind == "trust" else (b, a)
            m[at[a], at[b]] += n
        out = m.sum(1, keepdims=True)
        m = np.divide(m, out, out=np.zeros_like(m), where=out > 0)
        s = np.zeros(len(hosts))
        s[[at[h] for h in hs]] = 1
        r = s.copy()
        for _ in range(300):
            inward = r @ m
            r = s * (1 - U.DAMPING + U.DAMPING * (s.sum() - inward.sum()) / s.sum()) + U.DAMPING * inward
        found = {g.host: g["rank"] for g in got if g.kind == kind}
        assert np.allclose([found.get(h, 0) for h in hosts], r, atol=1e-5)


def test_linked_tables_equal_sql(spark):
    import duckdb

    df = linked(spark).select("page_id", "url", "html")
    db = duckdb.connect()
    rows = [tuple(r) for r in df.collect()]
    db.execute("create table pages (page_id bigint, url varchar, html varchar)")
    db.executemany("insert into pages values (?, ?, ?)", rows)
    assert compare(U.judge(df, URL_RULES).drop("trust", "distrust"), db, ORACLE["op8_url_filters"]) == []


def test_long_chain_is_followed_to_its_end(spark):
    import duckdb

    rows = [(0, "http://bad.net/", "")]
    rows += [(k, f"http://h{k}.com/", f"<a href='http://{f'h{k - 1}.com' if k > 1 else 'bad.net'}/'>") for k in range(1, 41)]
    df = spark.createDataFrame([*rows, (99, "http://alone.com/", "")], SCHEMA)
    got = U.judge(df, URL_RULES).drop("trust", "distrust")
    assert {r.page_id for r in got.where("verdict = 'allow'").collect()} == {99}
    db = duckdb.connect()
    db.execute("create table pages (page_id bigint, url varchar, html varchar)")
    db.executemany("insert into pages values (?, ?, ?)", [tuple(r) for r in df.collect()])
    assert compare(got, db, ORACLE["op8_url_filters"]) == []
