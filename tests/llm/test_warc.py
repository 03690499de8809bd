import gzip
import hashlib

import pytest
from oracle_check import compare, connect

from conftest import SF
from salesflow.llm import warc
from salesflow.llm.oracle import ORACLE
from salesflow.llm.queries import op6_warc
from salesflow.session import scratch_path

SCHEMA = "page_id bigint, url string, html string, digest string"
LONG = "<p>é ÿ \r\n\r\nWARC/1.1\r\n\r\n" + "x" * 200


def test_query_equals_sql(spark):
    assert compare(op6_warc(spark, SF), connect(SF), ORACLE["op6_warc"]) == []


def test_revisits_and_odd_rows(spark):
    rows = [
        (5, "http://a/x", LONG), (3, "http://a/y", LONG), (9, None, LONG), (3, "http://a/y", LONG),
        (1, "http://b/\r\nEvil: 1", "short"), (2, "no url", "short"), (4, "http://c", None), (6, "http://c", ""),
        (None, "http://d/", LONG), (None, None, "other" * 50), (7, "http://e/", "z" * 3_000_000), (8, "u", "y" * 100),
    ]
    df = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)
    got = warc.round_trip(df).collect()
    assert len(got) == len(rows)
    want = []
    for page, url, html in rows:
        body = (html or "").encode()
        again = html == LONG and page != 3
        want.append((page, url, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", 3 if again else None))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert warc.round_trip(df.limit(0)).collect() == []


def test_records_are_complete(spark):
    df = spark.createDataFrame([(1, "http://a/x?q#f", LONG, "c"), (2, "http://a/y", LONG, "c")], SCHEMA)
    where = scratch_path(spark, "warc-test")
    warc.write(warc.captures(df), where)
    rows = warc.read(spark, where, payloads=True).collect()
    assert sorted(r.type for r in rows) == ["metadata", "metadata", "request", "request", "response", "revisit"]
    response = next(r for r in rows if r.type == "response")
    assert bytes(response.payload) == LONG.encode() and response.payload_digest == response.payload_sha256
    assert next(r for r in rows if r.type == "revisit").refers_to == response.record_id
    nested = warc.assemble(warc.read(spark, where)).collect()
    assert len(nested) == 2 and all(len(r.requests) == len(r.metadata) == 1 and r.capture for r in nested)


def test_parser_takes_members_and_chains(spark):
    def rec(kind, name, block, **more):
        lines = [b"WARC/1.0", f"WARC-Type: {kind}".encode(), f"WARC-Record-ID: <{name}>".encode()]
        lines += [f"{k.replace('_', '-')}: {v}".encode() for k, v in more.items()]
        return b"\r\n".join([*lines, f"Content-Length: {len(block)}".encode()]) + b"\r\n\r\n" + block + b"\r\n\r\n"

    one, two = rec("response", "r", b"abc\r\n\r\ndef"), rec("request", "q", b"", WARC_Concurrent_To="<r>")
    for content in (one + two, gzip.compress(one) + gzip.compress(two), gzip.compress(one + two)):
        parsed = list(warc.parse(content))
        assert [h["warc-type"] for h, _ in parsed] == ["response", "request"]
        assert parsed[0][1] == b"abc\r\n\r\ndef"
    with pytest.raises(ValueError):
        list(warc.parse(one[:-8]))


def test_chains_of_concurrent_records(spark):
    names = [f.split()[0] for f in warc.FIELDS.split(", ")]

    def row(kind, name, to=None):
        return tuple({"type": kind, "record_id": name, "concurrent_to": to}.get(n) for n in names)

    rows = [row("response", "r1", "q1"), row("request", "q1"), row("metadata", "m1", "r1"), row("request", "q2"), row("response", "r3")]
    out = warc.assemble(spark.createDataFrame(rows, warc.FIELDS)).collect()
    found = {
        (r.capture.record_id if r.capture else None): ([x.record_id for x in r.requests or []], [x.record_id for x in r.metadata or []])
        for r in out
    }
    assert found == {"r1": (["q1"], ["m1"]), "r3": ([], []), None: (["q2"], [])}


def test_record_naming_two_others(spark):
    head = "WARC/1.0\r\nWARC-Type: metadata\r\nWARC-Concurrent-To: <r>\r\nWARC-Concurrent-To: <q>\r\nContent-Length: 0\r\n\r\n"
    [(headers, _)] = warc.parse(head.encode() + b"\r\n\r\n")
    assert headers["warc-concurrent-to"] == "<r> <q>"
    names = [f.split()[0] for f in warc.FIELDS.split(", ")]
    given = [("response", "<r>", None), ("request", "<q>", None), ("metadata", "<m>", headers["warc-concurrent-to"])]
    rows = [tuple({"type": k, "record_id": n, "concurrent_to": to}.get(f) for f in names) for k, n, to in given]
    [row] = warc.assemble(spark.createDataFrame(rows, warc.FIELDS)).collect()
    assert row.capture.record_id == "<r>"
    assert ([x.record_id for x in row.requests], [x.record_id for x in row.metadata]) == (["<q>"], ["<m>"])
