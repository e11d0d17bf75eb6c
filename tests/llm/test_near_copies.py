import random

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline as P
from cinderframe.llm import near_copies as N


def shingles(text, words=5):
    w = "".join(c.lower() if c < "\x7f" else c for c in text or "").split()
    return frozenset(tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))) if w else frozenset()


def brute_roots(texts):
    """The smallest place that each text reaches over pairs of Jaccard similarity 0.8 or more."""
    sets, root = [shingles(t) for t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            both, all_ = len(sets[i] & sets[j]), len(sets[i] | sets[j])
            if 5 * both >= 4 * all_ and root[i] != root[j]:
                a, b = sorted((root[i], root[j]))
                root = [a if x == b else x for x in root]
    return root


def corpus(seed):
    rng = random.Random(seed)
    fresh = lambda n: [f"u{rng.randrange(10**9)}" for _ in range(n)]
    line, texts = fresh(30), []
    for _ in range(40):
        base = fresh(rng.choice([3, 9, 14, 60, 200])) + (line if rng.random() < 0.5 else [])
        for _ in range(rng.choice([1, 2, 4])):  # copies with a share of words changed, around the limit
            copy = list(base)
            for _ in range(rng.randint(0, 1 + len(copy) // 30)):
                copy[rng.randrange(len(copy))] = fresh(1)[0]
            texts.append(" ".join(copy))
    crowd = fresh(120)
    for _ in range(60):  # one group of near copies of a text, not all near each other
        copy = list(crowd)
        for _ in range(rng.randint(1, 3)):
            copy[rng.randrange(120)] = fresh(1)[0]
        texts.append(" ".join(copy))
    rng.shuffle(texts)
    return texts + [texts[0].upper(), "  " + texts[1], None, "", " \n", "one", "One ", "a b c d e", "a b c d e f", "x " * 50, "x " * 70]


@pytest.mark.parametrize("seed", range(2))
def test_stage_equals_brute_force(spark, documents, seed):
    texts = corpus(seed)
    root = brute_roots(texts)
    docs = documents(texts)
    kept = P.near(spark, docs.repartition(3), "")
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, r in enumerate(root) if r == i]


def test_sample_changes_nothing(documents):
    texts = corpus(3)
    docs = documents(texts)
    want = {i for i, r in enumerate(brute_roots(texts)) if r == i}
    assert {r.id for r in N.near_copies(docs, sample=10).where("keep").collect()} == want


def test_ids_that_repeat_and_null_ids(spark):
    text = [f"w{i}" for i in range(60)]
    near, other = " ".join([*text[:-1], "z"]), " ".join(f"v{i}" for i in range(60))
    df = spark.createDataFrame([(5, " ".join(text)), (5, other), (3, near), (None, other + " z"), (None, "alone")], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.text) for r in N.drop_near_copies(df).collect()) == sorted([(5, other), (3, near), (0, "alone")])
    assert N.drop_near_copies(df.limit(0)).count() == 0


def test_pairs_of_near_copies_are_made_once(spark, documents):
    """Members who share many shingles come together at the least of them, not at each; and all pairs that a plain join finds are still made."""
    rng = np.random.default_rng(5)
    base = rng.integers(1, 2**40, 60)
    sets = [np.unique(np.where(rng.random(60) < 0.1, rng.integers(1, 2**40, 60), base)) for _ in range(30)]
    rows = sorted((int(h), 100, k, [*reversed([int(v) for v in x[:i]])][: N.PRIOR]) for k, x in enumerate(sets) for i, h in enumerate(x))
    table = {"shingle": [r[0] for r in rows], "n": pa.array([r[1] for r in rows], pa.int32()), "node": [r[2] for r in rows], "root": [r[2] for r in rows], "sketch": [bytes(8)] * len(rows)}
    met = {f"p{k}": [r[3][k] if k < len(r[3]) else r[0] for r in rows] for k in range(N.PRIOR)}
    made = [[(a, b) for out in N._pairs(iter([pa.RecordBatch.from_pydict(t)]), (4, 5), 1, 10**6) for a, b in zip(*(c.to_pylist() for c in out.columns))] for t in (table, table | met)]
    assert set(made[0]) == set(made[1]) and len(set(made[1])) == 30 * 29 / 2
    assert len(made[0]) > 40 * len(set(made[0])) and len(made[1]) < 2 * len(set(made[1]))


def test_parities_of_large_sets_tell_them_apart():
    """Sets of thousands of shingles with nothing in common are told apart before their shingles are compared; near ones and their own copies are not."""
    rng = np.random.default_rng(6)
    one, two = (rng.integers(0, 2**63, 5000).astype(np.uint64) for _ in range(2))
    short = one[:4090]
    x, y = [one, one, one, short, one], [two, one, np.r_[one[:4800], two[:200]], one, two[:4050]]
    sized = {k: pa.array([len(s) for s in v], pa.int32()) for k, v in (("na", x), ("nb", y))}
    rows = pa.RecordBatch.from_pydict({"a": range(5), "b": range(5), **sized, "x": [N._parity(s) for s in x], "y": [N._parity(s) for s in y]})
    (out,) = N._close(iter([rows]), (4, 5))
    assert out.column("a").to_pylist() == [1, 2, 3]
