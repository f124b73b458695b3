import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from reqlens.llm import prefix_trie as P
from tests.conftest import SF01
from tests.oracle_compare import compare, duckdb_connection

SCHEMA = "conv_id long, turn long, role string, text string"


def rebuilt(rows):
    """conv_id -> list of (role, text)."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn, role or "", text or ""))
    digest = lambda r, t: hashlib.sha256(f"{len(r.encode())}:{r}{t}".encode()).hexdigest()
    own = {
        c: [(r, t) for _, r, t in sorted(v, key=lambda x: (x[0] is not None, x[0] or 0, digest(x[1], x[2])))] for c, v in own.items()
    }
    out = {}
    for c, turns in own.items():
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)  # the remainder has the sign of c
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def slow_trie(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for path, of in members.items():
        d = len(path)
        under = [p for p in members if p[:d] == path]
        children = [p for p in under if len(p) == d + 1]
        leaf = lambda p: not any(q[: len(p)] == p and len(q) == len(p) + 1 for q in under)
        ends = sorted(c for c in of if len(convs[c]) == d)
        out.append(
            (
                min(of), d, min(members[path[:-1]]) if d else None, len(of), len(children), sum(map(leaf, under)),
                sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in under if p),
                hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
            )
        )
    return sorted(out, key=str)


def result(df):
    columns = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def table(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumns({c: F.lit("x") for c in ("key", "pos", "a", "depth", "above", "bytes", "digest")})


def awkward():
    rng = random.Random(1)
    rows = [(c, t, rng.choice(["user", "assistant"]), rng.choice(["é", "yes", "no"])) for c in range(-12, 40) for t in range(rng.randint(1, 9))]
    rows += [(3, None, None, None), (3, None, "user", "tie"), (3, None, "user", "tie"), (3, 0, None, ""), (None, 1, "user", "nobody's"), (70, 5, None, None)]
    rows += [(100 + k, t, "user", f"same {t}") for k in range(40) for t in range(3)]  # a third begin alike
    rows += [(500, t, "user", "x" * 20_000 if t == 3 else f"deep {t % 7}") for t in range(90)]  # many bands
    return rows


@pytest.mark.parametrize("band", [None, 1, 3])
def test_matches_brute_force(spark, band):
    turns, convs = P.grafted(P.turn_digests(table(spark, awkward())))
    assert result(P.trie(turns, convs, band)) == slow_trie(rebuilt(awkward()))


def test_ends_are_hashed_piece_by_piece(spark, monkeypatch):
    monkeypatch.setattr(P, "PIECE", 20)
    rows = [(k, 1, "user", "same") for k in range(200) if zlib.crc32(str(k).encode()) % 9 == 0]
    turns, convs = P.grafted(P.turn_digests(table(spark, rows)))
    assert result(P.trie(turns, convs)) == slow_trie(rebuilt(rows))


def test_empty_and_all_null_tables(spark):
    for rows in ([], [(None, None, None, None)]):
        turns, convs = P.grafted(P.turn_digests(table(spark, rows)))
        assert result(P.trie(turns, convs)) == []


def test_query_matches_sql(spark):
    name = "op11_prefix_trie"
    assert compare(queries()[name](spark, SF01), duckdb_connection(SF01), oracle_sql()[name]) == []
