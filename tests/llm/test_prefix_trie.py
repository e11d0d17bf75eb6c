import hashlib
import random
import zlib

import duckdb
import pytest

from cinderframe.llm.ordering import positions
from cinderframe.llm.prefix_trie import ORACLE, _subtrees, op11_prefix_trie, prefix_trie, rebuilt


def brute(rows):
    """The query's rows for (conv_id, turn, role, text)."""
    own = {}
    for c, t, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(turns)] for c, turns in own.items()}
    members, ended = {}, {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built = tuple(own.get(c - (abs(c) % 5) * (1 if c >= 0 else -1), [])[:h] + turns[h:])
        for d in range(len(built) + 1):
            members.setdefault(built[:d], []).append(c)
        ended.setdefault(built, []).append(c)
    kids = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        below = kids.get(p, [])
        leaves[p] = sum(leaves[k] for k in below) if below else 1
        saved[p] = sum(saved[k] for k in below) + (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0)
    sha = lambda p: hashlib.sha256(",".join(map(str, sorted(ended.get(p, [])))).encode()).hexdigest()
    return [(min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids.get(p, [])), leaves[p], saved[p], sha(p)) for p, m in members.items()]


def awkward():
    draw = random.Random(3)
    rows = [(c, t, draw.choice(["user", "assistant"]), draw.choice(["a", "b", "é", ""])) for c in range(-12, 90) for t in range(draw.randrange(1, 12))]
    rows += [(c, t, "user", "same") for c in range(200, 3500) for t in range(3)]  # a node at which thousands end
    rows += [(5000, t, "user", str(t % 7)) for t in range(400)] + [(5001, t, "user", str(t % 7)) for t in range(350)]  # deep chains
    return rows + [(None, 1, "user", "x"), (6000, None, None, None), (6000, 4, "user", "long " * 100_000), (6001, 1, "user", "tie"), (6001, 1, "user", "tie")]


@pytest.mark.parametrize("part", [20_000, 40])
def test_trie_equals_brute_force(spark, part):
    rows = awkward()
    df = spark.createDataFrame([(*r, 1, "y") for r in rows], "conv_id long, turn long, role string, text string, depth int, bytes string").repartition(5)
    got = [tuple(r) for r in prefix_trie(*rebuilt(df), part_nodes=part).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, brute(rows)))


def test_query_equals_its_sql(spark, sf):
    db = duckdb.connect()
    db.sql(f"create view conversations as select * from '{sf}/conversations.parquet'")
    got = [tuple(r) for r in op11_prefix_trie(spark, sf).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, db.sql(ORACLE).fetchall()))
    assert sorted(map(repr, got)) == sorted(map(repr, brute([tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()])))


def test_empty(spark):
    assert prefix_trie(*rebuilt(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).count() == 0


def test_subtrees_of_any_shape():
    draw = random.Random(5)
    for shape in ("random", "chain", "star"):
        n = 300
        parents = [-1] + [draw.randrange(v) if shape == "random" else v - 1 if shape == "chain" else 0 for v in range(1, n)]
        value = [draw.randrange(10) for _ in range(n)]
        want = list(value)
        for v in range(n - 1, 0, -1):
            want[parents[v]] += want[v]
        # Ids that grow with the parent's are an order in which parents come first.
        assert [s[0] for s in _subtrees(parents, [value])] == want


def test_running_sums(spark):
    df = spark.createDataFrame([(k % 3 if k % 5 else 1, k, (k * 7919) << 38) for k in range(2000)], "k long, v long, s long").repartition(9)
    sums = {}
    for r in sorted(positions(df, "k", "v", sums=("s",)).collect(), key=lambda r: r.v):
        sums[r.k] = (sums.get(r.k, 0) + ((r.v * 7919) << 38)) % 2**64
        assert r.s % 2**64 == sums[r.k]
