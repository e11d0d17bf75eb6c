import math
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from cinderframe.llm import pitman_yor
from cinderframe.llm.pitman_yor import op12_pitman_yor, reseat, scored


def tokens(text):
    return [w.translate({c: c + 32 for c in range(65, 91)}) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")] + [None]


def plain(rows, held):
    """Counts and base scores by the contract."""
    train = Counter(t for (_, text), h in zip(rows, held) if not h for t in tokens(text))
    n, v = sum(train.values()), len(train)
    return [(i, h, len(tokens(x)), sum(train[t] > 0 for t in tokens(x)), n, sum(math.log10((train[t] + 1) / (n + v + 1)) for t in tokens(x))) for (i, x), h in zip(rows, held)]


TEXTS = ["The cat sat.", "the CAT sat. the dog", None, "", " \t\n", "é É ß the", "word " * 40_000, "unheard of"] + ["copy of the copy"] * 60 + [f"n{i} the n{i % 7} of" for i in range(200)]


def test_counts_and_base_equal_the_contract(spark, tmp_path):
    rows = list(enumerate(TEXTS)) + [(None, "the null one"), (3, "the third again"), (3, "the third again")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, id int, held_out string")
    df.repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in op12_pitman_yor(spark, str(tmp_path)).collect()]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:5])
    for g, w in zip(sorted(got, key=key), sorted(plain(rows, held), key=key), strict=True):
        assert g[:5] == w[:5] and abs(g[5] - w[5]) < 1e-6 and g[6] < 0
    df.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert op12_pitman_yor(spark, f"{tmp_path}/none").count() == 0


def test_probabilities_of_what_may_follow_a_word_sum_to_one(spark):
    train = ["a b a b c", "b a c", "a a b", "c", "", "a b", "a b a"] * 3
    words = ["a", "b", "c", "q"]  # q is unknown, and stands for all that is
    probes = ["", *words, *[f"{x} {y}" for x in words for y in words]]
    rows = [(i, x, False) for i, x in enumerate(train)] + [(1000 + i, x, True) for i, x in enumerate(probes)]
    df = spark.createDataFrame(rows, "doc_id long, text string, aside boolean")
    got = {r.id: 10**r.score for r in scored(df, F.col("aside"), bucket_tokens=20).collect()}
    s = {x: got[1000 + i] for i, x in enumerate(probes)}
    # With B the probabilities at the beginning: s(xy) = B(x) P(y|x) P(end|y) and s(y) = B(y) P(end|y), so P(.|x) adds to one if B solves this system.
    a = np.array([[(x == y) - s[f"{x} {y}"] / s[y] for y in words] for x in words])
    begin = np.linalg.solve(a, [s[x] for x in words])
    assert (begin > 0).all() and abs(begin.sum() + s[""] - 1) < 1e-4


def test_moves_leave_the_posterior_as_it_is():
    """Of three customers who share a dish, the number of tables is distributed as the restaurant's rule has it."""
    d, new, draw = 0.5, 0.8, np.random.default_rng(1)
    want = np.array([(1 - d) * (2 - d), new * 3 * (1 - d), new * new])
    n = 60_000
    sizes, t = reseat(np.full(n, 3), np.ones(n, np.int64), np.full(n, new), d, 30, draw)
    assert sizes.sum() == 3 * n and len(sizes) == t.sum()
    assert np.abs(np.bincount(t, minlength=4)[1:] / n - want / want.sum()).max() < 0.01


def test_a_sweep_moves_every_customer():
    """Where new tables are all but certain, one sweep leaves nobody at the old table; and customers who come or go do it by the rule too."""
    draw = np.random.default_rng(2)
    sizes, t = reseat(np.array([3000, 1, 40]), np.ones(3, np.int64), np.full(3, 1e12), 0.5, 1, draw)
    assert t.tolist() == [3000, 1, 40] and (sizes == 1).all()
    d, new, n = 0.5, 0.8, 60_000
    want = np.array([(1 - d) * (2 - d), new * 3 * (1 - d), new * new])
    for before in (0, 1, 2, 9):  # customers of each dish, who all become three
        t = np.full(n, min(before, 1))
        sizes, t = reseat(np.full(n * min(before, 1), before), t, np.full(n, new), d, 20, draw, np.full(n, 3))
        assert sizes.sum() == 3 * n and np.abs(np.bincount(t, minlength=4)[1:] / n - want / want.sum()).max() < 0.01
    sizes, t = reseat(np.array([5, 2, 4]), np.array([1, 2, 0]), np.ones(3), d, 1, draw, np.array([0, 1, 0]))
    assert sizes.tolist() == [1] and t.tolist() == [0, 1, 0]


def test_texts_like_the_training_ones_are_likelier(spark, sf):
    got = op12_pitman_yor(spark, sf).where("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b"), F.count("*").alias("n")).first()
    assert got.n > 10 and got.s > got.b


def test_result_does_not_depend_on_the_order_of_rounds(spark):
    df = spark.createDataFrame([(i, x, i % 7 == 2) for i, x in enumerate(TEXTS)], "doc_id long, text string, aside boolean").coalesce(1)
    one, two = ({r.id: r.score for r in scored(df, F.col("aside"), bucket_tokens=30_000).collect()} for _ in range(2))
    assert one == two and pitman_yor.ROUNDS > pitman_yor.BURN_IN
