import random
import re

import numpy as np
import pytest
import xxhash

from cinderframe.llm import simhash
from cinderframe.llm.components import components

WORDS = [f"w{i}" for i in range(40)] + ["Ünï", "ABC", "é"]


def brute_fp(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << k for k in range(64) if sum(h >> k & 1 for h in hs) * 2 > len(hs))


def brute_components(fps):
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [root(i) for i in range(len(fps))]


def test_documents(documents):
    rng = random.Random(1)
    base = [" ".join(rng.choices(WORDS, k=rng.choice([0, 1, 2, 3, 5, 300]))) for _ in range(60)]
    near = [t.replace("w7", "w8", 1) for t in base]
    texts = base + near + [None, "", "  ", "one", "One  ", " x y z", "long " * 30_000, "\x0b\x0ca\x0d"]
    rows = {r.doc_id: r for r in simhash.near_groups(documents(texts)).collect()}
    fps = [brute_fp(t) for t in texts]
    assert [rows[i].fp & (2**64 - 1) for i in range(len(texts))] == fps
    assert [rows[i].component_id for i in range(len(texts))] == brute_components(fps)


@pytest.mark.parametrize("small", [2, 16, 100_000])
def test_links_at_every_depth(spark, small):
    rng = np.random.default_rng(3)
    centre = rng.integers(0, 2**64, 12, dtype=np.uint64)
    fps = set(centre.tolist())
    for _ in range(900):  # one crowded neighbourhood and some quiet ones
        x = int(centre[0] if rng.random() < 0.7 else rng.choice(centre))
        for b in rng.integers(0, 64, rng.integers(0, 4)):
            x ^= 1 << int(b)
        fps.add(x)
    fps = sorted(fps)
    df = spark.createDataFrame([(x - 2**64 if x >= 2**63 else x,) for x in fps], "fp long")
    found = simhash.links(df, small).collect()
    assert all(((r.a ^ r.b) & (2**64 - 1)).bit_count() <= 2 for r in found)
    parent = {x: x for x in fps}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for r in found:
        a, b = sorted((root(r.a & (2**64 - 1)), root(r.b & (2**64 - 1))))
        parent[b] = a
    assert [fps.index(root(x)) for x in fps] == brute_components(fps)


def test_walk_finds_all_pairs():
    rng = np.random.default_rng(5)
    x = np.unique(rng.integers(0, 2**10, 300, dtype=np.uint64))
    found = []
    simhash.walk(x, x, True, 31, 2, found)
    got = sorted((a, b) for p, q in found for a, b in zip(p.tolist(), q.tolist()))
    assert got == sorted((a, b) for a in x.tolist() for b in x.tolist() if a < b and (a ^ b).bit_count() <= 2)


def test_long_chain(spark):
    df = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(None, 3), (5, 5)], "a long, b long")
    assert {r.node: r.root for r in components(df).collect()} == {i: 0 for i in range(1, 201)}


def test_empty(documents):
    assert simhash.near_groups(documents(["a"]).limit(0)).count() == 0


def test_query_columns(spark, documents, tmp_path):
    rng = random.Random(6)
    base = [" ".join(rng.choices(WORDS, k=300)) for _ in range(12)]
    texts = base + [t.replace("w7", "w8", 1) for t in base] + [base[0]] * 3 + [None, "", "long " * 30_000]
    documents(texts).union(documents(texts[:1])).write.parquet(f"{tmp_path}/documents.parquet")
    rows = simhash.op7_simhash(spark, str(tmp_path)).collect()
    fps = [brute_fp(t) for t in texts]
    root = brute_components(fps)
    assert sorted(map(tuple, rows)) == sorted([(i, f"{fps[i]:016x}", root[i]) for i in range(len(texts))] + [(0, f"{fps[0]:016x}", root[0])])
