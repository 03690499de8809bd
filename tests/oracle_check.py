"""Runs queries and their SQL side by side: ``python tests/oracle_check.py [sf_dir] [name ...]``."""

from __future__ import annotations

import datetime
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return db


def _plain(value):
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, float) and value == 0:
        return 0.0
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def _sorted(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(plain, key=repr)


SPARK_TYPES = {
    "INTEGER": "int",
    "BIGINT": "bigint",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "DATE": "date",
}


def compare(df, db, sql: str) -> list[str]:
    """What differs between the two results; empty when they are equal."""
    problems = []
    cursor = db.execute(sql)
    names = [d[0] for d in cursor.description]
    types = {d[0]: SPARK_TYPES.get(str(d[1]), str(d[1])) for d in cursor.description}
    want_names, want = _sorted(names, cursor.fetchall())
    got_names, got = _sorted(df.columns, [tuple(r) for r in df.collect()])
    if got_names != want_names:
        return [f"columns {got_names} != {want_names}"]
    for name, have in df.dtypes:
        if have != types[name]:
            problems.append(f"type of {name}: {have} != {types[name]}")
    if len(got) != len(want):
        problems.append(f"{len(got)} rows != {len(want)}")
    elif got != want:
        bad = [(g, w) for g, w in zip(got, want, strict=True) if g != w]
        problems.append(f"{len(bad)} of {len(got)} rows differ, e.g. {bad[0]}")
    return problems


if __name__ == "__main__":
    import __spark_entry__ as entry
    from salesflow.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark = build_session(
        master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__ui__showConsoleProgress="false"
    )
    spark.sparkContext.setLogLevel("ERROR")
    db, oracle = connect(sf), entry.oracle_sql()
    failed = []
    for name, run in entry.queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            if name in oracle:
                problems = compare(run(spark, sf), db, oracle[name])
            else:
                rows = run(spark, sf).collect()
                problems = [] if rows else ["no rows"]
        except Exception as e:
            problems = [f"{type(e).__name__}: {str(e)[:600]}"]
        mark = "ok" if not problems else "FAIL"
        kind = "O" if name in oracle else "R"
        print(f"{mark:4} {kind} {time.time() - start:6.2f}s {name}", *problems, sep="\n     ", flush=True)
        if problems:
            failed.append(name)
    print("failed:", failed)
