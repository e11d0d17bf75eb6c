import random
from collections import defaultdict

import numpy as np
import pytest

from cinderframe.llm import suffix_dedup as S

L, K = 10, 3


def brute(texts, n=L):
    """Words covered by removed and by kept repeats of n words."""
    seen, covered = defaultdict(list), {True: defaultdict(set), False: defaultdict(set)}
    for i, t in enumerate(texts):
        words = (t or "").split()
        for s in range(len(words) - n + 1):
            seen[tuple(words[s : s + n])].append((i, s))
    for places in seen.values():
        for k, (i, s) in enumerate(sorted(places)):
            if len(places) > 1:
                covered[k > 0][i].update(range(s, s + n))
    return covered


def spans_of(words):
    out = []
    for w in sorted(words):
        if out and out[-1][1] == w:
            out[-1][1] = w + 1
        else:
            out.append([w, w + 1])
    return [tuple(x) for x in out]


def corpus(seed):
    rng = random.Random(seed)
    fresh = lambda n: [f"u{rng.random()}" for _ in range(n)]
    passages = [fresh(rng.choice([8, 9, 10, 11, 15, 60])) for _ in range(12)]
    texts = []
    for _ in range(120):
        words = []
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(passages)
            a = rng.randint(0, 3)
            words += fresh(rng.randint(0, 15)) + p[a : a + rng.randint(5, len(p))] + fresh(rng.randint(0, 2))
        texts.append(" ".join(words))
    few = [" ".join(rng.choices(["a", "b"], k=rng.randint(0, 40))) for _ in range(20)]  # many overlapping repeats
    return texts + texts[:5] + few + [None, "", " \n", "word " * 400, "z " * 9, "z " * 10, "Ünï " * 12]


@pytest.mark.parametrize("seed", range(3))
def test_covers_what_brute_force_covers(documents, seed):
    texts = corpus(seed)
    want = brute(texts)
    got = {True: defaultdict(list), False: defaultdict(list)}
    for r in S.repeats(documents(texts).repartition(3), L, K).collect():
        got[r.removed][r.doc].append((r.start, r.end))
        assert r.other is not None
    for removed in (True, False):
        assert {i: sorted(x) for i, x in got[removed].items()} == {i: spans_of(x) for i, x in want[removed].items() if x}


def test_removal(documents):
    texts = corpus(7)
    gone = brute(texts)[True]
    left = {i: [w for k, w in enumerate((t or "").split()) if k not in gone[i]] for i, t in enumerate(texts)}
    docs = documents(texts)
    out = S.remove_repeats(docs, L, K)
    assert out.columns == docs.columns
    rows = {r.doc_id: r for r in out.collect()}
    assert {i: (r.text or "").split() for i, r in rows.items()} == {i: x for i, x in left.items() if x or not gone[i]}
    assert all(r.n_chars == len(r.text or "") for r in rows.values())
    assert all(rows[i].text == t for i, t in enumerate(texts) if not gone[i])


def test_repeated_rows_null_ids_and_empty(spark, documents):
    text = " ".join(map(str, range(30)))
    df = spark.createDataFrame([(1, text), (1, text), (None, text), (None, text)], "doc_id long, text string")
    assert not S.repeats(df, L, K).where("removed").count()
    assert S.remove_repeats(df, L, K).count() == 4
    assert S.repeats(documents(["a"]).limit(0), L, K).count() == 0
    assert S.remove_repeats(documents(["a"]).limit(0), L, K).count() == 0


def test_sliding_argmin():
    x = np.random.default_rng(1).integers(0, 5, 60).astype(np.uint64)
    for w in (1, 2, 5, 8, 39):
        assert S.sliding_argmin(x, w).tolist() == [i + int(x[i : i + w].argmin()) for i in range(60 - w + 1)]


def test_neighbours_do_not_depend_on_batches():
    import pyarrow as pa

    rng = np.random.default_rng(4)
    n = 200
    rows = sorted(zip(rng.integers(0, 60, n).tolist(), rng.integers(0, 2, n).tolist(), rng.integers(0, 9, n).tolist(), rng.integers(0, 3, n).tolist()))
    table = pa.table({"gram": [r[0] for r in rows], "context": [r[1] for r in rows], "doc": [r[2] for r in rows], "lo": pa.array([r[3] for r in rows], pa.int32()), "hi": pa.array([r[3] for r in rows], pa.int32())})
    run = lambda size: pa.Table.from_batches(list(S.compare_neighbours(iter(table.to_batches(max_chunksize=size))))).to_pylist()
    told = [sorted(run(size), key=str) for size in (1, 2, 7, 50, 1000)]
    assert all(t == told[0] for t in told)
    # All rows in one partition: only a k-gram at its edge may count as one of several contexts without being it.
    contexts = {g: {c for h, c, _, _ in rows if h == g} for g in {r[0] for r in rows}}
    for r in told[0]:
        if r["first"] and r["gram"] not in (rows[0][0], rows[-1][0]):
            assert r["several"] == (len(contexts[r["gram"]]) > 1)
