import random
import zlib

import numpy as np

from cinderframe.llm import quality as Q


def test_statistics_of_small_texts():
    texts = ["", "ab AB 12!!\nab AB 12!!\n", "Ü x"]
    data = "".join(texts).encode()
    x = Q.statistics_of(np.frombuffer(data, np.uint8), np.cumsum([0] + [len(t.encode()) for t in texts]))
    col = lambda k: x[:, Q.STATISTICS.index(k)]
    assert not x[0].any()
    assert np.allclose(col("upper"), [0, 4 / 22, 0]) and np.allclose(col("high"), [0, 0, 2 / 4])
    assert np.allclose(col("distinct_words"), [0, 0.5, 1]) and np.allclose(col("distinct_lines"), [0, 0.5, 1])
    assert np.allclose(col("marked_words"), [0, 1 / 3, 0]) and np.allclose(np.expm1(col("word_bytes")), [0, 16 / 6, 3 / 2])


def test_isotonic_levels_are_the_best_monotone_fit():
    rng = np.random.default_rng(1)
    n = rng.integers(0, 5, 12).astype(float)
    y = rng.binomial(n.astype(int), 0.5).astype(float)
    got = Q.pooled(y, n)
    assert (np.diff(got) >= -1e-12).all()
    some = np.flatnonzero(n)
    # max over i <= k of min over j >= k of the mean of i..j
    for k in some:
        want = max(min(y[i : j + 1].sum() / n[i : j + 1].sum() for j in some if j >= k) for i in some if i <= k)
        assert abs(got[k] - want) < 1e-9


def rows(n, seed):
    rng = random.Random(seed)
    good = lambda: " ".join("".join(rng.choices("abcdefgh", k=rng.randint(1, 7))) for _ in range(rng.randint(5, 200)))
    return [(good(), 1) if rng.random() < 0.8 else (" ".join(w.upper() + "!!" for w in good().split()), 0) for _ in range(n)]


def test_learns_and_scores_every_row(spark, documents):
    data = rows(600, 1)
    new = [*rows(100, 2), (None, None), ("", None), ("word " * 30_000, 1)]
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(data)] + [(None, 1), (5, None)], "id long, label int")
    docs = documents([t for t, _ in data + new])
    out = {r.doc_id: r.score for r in Q.quality(docs, labels).collect()}
    assert len(out) == len(data) + len(new) and all(0 <= s <= 1 for s in out.values())
    right = [(out[len(data) + i] >= Q.THRESHOLD) == y for i, (_, y) in enumerate(new[:100])]
    assert np.mean(right) > 0.97


def test_partial_sums_give_the_same_model(spark, documents, monkeypatch):
    data = rows(300, 4)
    stats = Q.statistics(documents([t for t, _ in data])).repartition(4)
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(data)], "id long, label int")
    one = Q.fit(stats, labels)
    monkeypatch.setattr(Q, "ROWS_PER_SUM", 40)
    many = Q.fit(stats, labels)
    assert np.allclose(one.weights, many.weights, atol=1e-6)
    rows_ = stats.collect()
    x, order = np.array([[r[k] for k in Q.STATISTICS] for r in rows_]), [r.id for r in rows_]
    z, y = one.cosines(x), np.array([data[i][1] for i in order], float)
    s = z.T @ z
    assert np.allclose(one.weights[-1], np.linalg.solve(s + Q.RIDGE * np.trace(s) / len(s) * np.eye(len(s)), z.T @ y), atol=1e-6)


def test_without_labels(spark, documents):
    docs = documents(["a", None])
    none = spark.createDataFrame([], "id long, label int")
    assert {r.score for r in Q.quality(docs, none).collect()} == {0.5}
    assert {r.score for r in Q.quality(docs, spark.createDataFrame([(0, 1)], "id long, label int")).collect()} == {1.0}
    assert Q.quality(docs.limit(0), none).count() == 0


def test_query_equals_brute_force(spark, documents, tmp_path):
    """Columns and folds of the query, and its scores against the same model fitted in plain numpy from all labelled rows outside the fold."""
    data = rows(400, 4) + [(None, 1), ("", 0)]
    texts = [t for t, _ in data] + ["word " * 100_000, None]
    documents(texts).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, y, 0) for i, (_, y) in enumerate(data)] + [(None, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r.doc_id: r for r in Q.op3_quality(spark, str(tmp_path)).collect()}
    assert sorted(got) == list(range(len(texts))) and set(got[0].asDict()) == {"doc_id", "held_out", "score", "predicted"}
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1
    parts = [(t or "").encode() for t in texts]
    x = Q.statistics_of(np.frombuffer(b"".join(parts), np.uint8), np.cumsum([0] + [len(p) for p in parts]))
    known = [i for i in range(len(data)) if zlib.crc32(str(i).encode()) % 5 > 0]
    stats = Q.durable(Q.statistics(documents(texts)))
    labels = spark.createDataFrame([(i, data[i][1]) for i in known], "id long, label int")
    model = Q.fit(stats, labels)
    z, y = model.cosines(x[known]), np.array([data[i][1] for i in known], float)
    gram = z.T @ z
    w = np.linalg.solve(gram + Q.RIDGE * max(1.0, np.trace(gram)) / len(gram) * np.eye(len(gram)), z.T @ y)
    assert np.allclose(w, model.weights[-1], atol=1e-6)
    want = model.calibrated(model.cosines(x) @ w)
    assert max(abs(got[i].score - want[i]) for i in got) < 0.02
    held = [i for i in range(len(data) - 2) if got[i].held_out]
    assert np.mean([got[i].predicted == data[i][1] for i in held]) > 0.9
