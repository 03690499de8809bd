import hashlib
import itertools
import random
import sys
import zlib

import numpy as np
import pytest

from conftest import SF
from oracle_check import compare, connect
from salesflow.llm import repair
from salesflow.llm.oracle import ORACLE
from salesflow.llm.queries import QUERIES

NAME = "op11_conversation_repair"
SPACE = " \t\n\x0b\x0c\r"


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        body = text.rstrip(SPACE)
        if not body:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if body[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def best(rows):
    """(cost, audit, repaired lines) by trying from the last row on, every node by itself."""
    found, after = faults(rows), {"": "u", "s": "u", "u": "a", "a": "u"}
    full = {"u": "user", "a": "assistant"}
    legal = {"": "su", "s": "u", "u": "a", "a": "u"}
    memo = {}
    sys.setrecursionlimit(10_000)

    def go(i, state, inserts):
        if (i, state, inserts) in memo:
            return memo[i, state, inserts]
        options = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
        if inserts < 3:
            c, a, lines = go(i, after[state], inserts + 1)
            options.append((c + 3, "I" + a, (full[after[state]] + ":", *lines)))
        if i < len(rows):
            role, text = rows[i]
            c, a, lines = go(i + 1, state, 0)
            options.append((c + 4, "D" + a, lines))
            if found[i] not in ("blank", "duplicate"):
                extra = 3 * (found[i] == "truncated")
                if role[:1] and role[0] in legal[state]:
                    c, a, lines = go(i + 1, role[0], 0)
                    options.append((c + extra, "K" + a, (f"{role}:{text}", *lines)))
                c, a, lines = go(i + 1, after[state], 0)
                options.append((c + 3 + extra, "R" + a, (f"{full[after[state]]}:{text}", *lines)))
        memo[i, state, inserts] = min(options) if options else (1 << 30, "", ())
        return memo[i, state, inserts]

    return go(0, "", 0)


def run(spark, data):
    df = spark.createDataFrame(data, "conv_id string, turn bigint, role string, text string")
    found = repair.repair(df)
    hashes = {r.key: r.repaired_sha256 for r in repair.digests(found.rows, "conv_id").collect()}
    return {r.conv_id: r for r in found.conversations.collect()}, hashes


def some(rng, n):
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", "usher", "Assistant"]
    texts = ["Yes.", "No!", "open end", "", " \t", "Why? ", "a.b"]
    return [(rng.choice(roles), rng.choice(texts)) for _ in range(n)]


@pytest.mark.parametrize("bits", [14, 2])
def test_against_trying_everything(spark, monkeypatch, bits):
    # Short chunks too: then nearly every conversation is chained over several.
    monkeypatch.setattr(repair, "CHUNK_BITS", bits)
    rng = random.Random(bits)
    said = {f"c{k}": some(rng, rng.choice([1, 2, 3, 5, 8, 13])) for k in range(60)} | {"long": some(rng, 300)}
    data = [(c, i, *row) for c, rows in said.items() for i, row in enumerate(rows)]
    rng.shuffle(data)
    got, hashes = run(spark, data)
    assert set(got) == set(said)
    for c, rows in said.items():
        cost, audit, lines = best(rows)
        assert (got[c].cost, got[c].audit) == (cost, audit), rows
        want = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        assert hashes.get("=" + c, hashlib.sha256(b"").hexdigest()) == want
        kinds = faults(rows)
        assert [got[c][k] for k in repair.FAULTS] == [kinds.count(k) for k in repair.FAULTS]
        pairs = ["".join((a[0][:1], b[0][:1])) for a, b in itertools.pairwise(rows)]
        assert got[c].illegal == sum(p not in ("su", "ua", "au") for p in pairs)


def test_ranks_are_those_of_the_audits():
    rng = np.random.default_rng(3)
    codes = rng.choice([0, 1, 2, 3, 5, 6, 7, 10, 11], (40, 9))
    lengths = np.full(40, 9)
    ends, audits = repair._least_paths(codes, lengths, np.broadcast_to(repair._LAST, (40, 4)))
    for four, reached in zip(audits, ends, strict=True):
        assert all(len(a.replace(b"I", b"")) == 9 for a in four)
        assert set(reached) <= {0, 1, 2, 3}


def test_query_equals_sql(spark):
    assert compare(QUERIES[NAME](spark, SF), connect(SF), ORACLE[NAME]) == []


def test_odd_rows(spark):
    data = [
        (None, None, None, None),
        (None, 2, "user", "Hi."),
        ("", 1, "user", "Hi."),
        ("", 5, "assistant", "Yes."),
        ("n", None, "user", "Hi."),
        ("n", None, "user", "Hi."),
        ("n", 3, "assistant", "word. " * 60_000),
        ("d", 1, "", "x"),
    ]
    got, hashes = run(spark, data)
    assert set(got) == {None, "", "n", "d"}
    assert (got[""].gaps, got[""].cost, got[""].audit) == (3, 0, "KK")
    assert hashes["="] == hashlib.sha256(b"user:Hi.\nassistant:Yes.").hexdigest()
    assert (got["n"].gaps, got["n"].duplicate, got["n"].audit) == (0, 1, "KDK")
    assert (got[None].blank, got[None].gaps, got[None].audit) == (1, 0, "DKI")
    assert (got["d"].truncated, got["d"].illegal, got["d"].audit) == (1, 0, "D")


def test_empty_table_and_other_columns(spark):
    df = spark.createDataFrame(
        [(1, 1, "user", "Hi.", "x", 2), (1, 2, "assistant", "Yes.", None, 3)],
        "conv_id bigint, turn bigint, role string, text string, key string, place int",
    )
    found = repair.repair(df)
    assert [tuple(r) for r in found.conversations.collect()] == [(1, 0, 0, 0, 0, 0, 0, "KK")]
    assert [(r.role, r.text) for r in found.rows.orderBy("place", "line").collect()] == [("user", "Hi."), ("assistant", "Yes.")]
    none = repair.repair(df.limit(0))
    assert none.conversations.count() == 0 and none.rows.count() == 0


def test_damage(spark):
    rows = [(c, t, "assistant", "So. it! is?") for c in range(30) for t in range(4)] + [(None, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = sorted(tuple(r) for r in repair.damaged(df.where("conv_id is not null")).collect())
    want = []
    for c, t, role, text in rows[:-1]:
        hit = zlib.crc32(f"{c}:{t}".encode()) % 20
        if hit == 0:
            continue
        text = "" if hit == 1 else "So it is" if hit == 2 else text
        want += [(c, t, "user" if hit == 4 else role, text)] * (2 if hit == 3 else 1)
    assert got == sorted(want)
    assert [tuple(r) for r in repair.damaged(df.where("conv_id is null")).collect()][0] == (None, None, " ", " ")
