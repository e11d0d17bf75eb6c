import random
import zlib

import numpy as np

from cinderframe.llm import language_id as L

VOWELS = {"aa": "ka ti mo ".split(), "bb": "ßz ör üng ".split(), "cc": "的是 了不 在人".split()}


def texts(n, seed=0):
    rng = random.Random(seed)
    return [(lang, " ".join("".join(rng.choices(s, k=2)) for _ in range(rng.choice([20, 80, 300])))) for _ in range(n) for lang, s in VOWELS.items()]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, 1) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string, score int")


def test_held_out_accuracy_and_odd_texts(spark):
    rows = texts(120)
    docs = frame(spark, rows)
    model = L.learn(docs)
    assert model.langs == ["aa", "bb", "cc"]
    odd = [(None, None), (None, ""), (None, "12 34 !?"), (None, "的"), (None, "katimo " * 20_000)]
    got = {r.doc_id: r for r in L.identify(frame(spark, texts(30, 5) + odd), model).collect()}
    new = texts(30, 5)
    assert np.mean([got[i].lang_pred == lang for i, (lang, _) in enumerate(new)]) > 0.97
    tail = [got[len(new) + i] for i in range(5)]
    assert [r.lang_pred for r in tail[:3]] == ["und"] * 3 and all(r.score == 0 for r in tail[:3])
    assert tail[3].lang_pred != "und" and tail[4].lang_pred == "aa"
    assert all(0 <= r.score <= 1 for r in got.values())
    kept = L.drop_unknown(frame(spark, rows + odd), 0.0)
    assert kept.columns == ["doc_id", "text", "lang", "score"] and kept.count() >= len(rows)
    assert not {len(rows), len(rows) + 1, len(rows) + 2} & {r.doc_id for r in kept.collect()}


def test_pairs_equal_plain_convolution():
    rng = np.random.default_rng(2)
    x, _, _ = L.windows(np.frombuffer(b"Some words of text, 12 of them. " * 30, np.uint8), np.array([0, 100, 960]))
    model = L.train(x, rng.integers(0, 2, len(x)), ["p", "q"], epochs=1)
    pooled = [np.max([sum(t[k][x[:, i + k]] for k in range(w)) for i in range(L.WINDOW - w + 1)], axis=0) for w, t in model.tables.items()]
    z = np.maximum(np.concatenate(pooled, axis=1) + model.bias, 0) @ model.out + model.out_bias
    p = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
    assert np.allclose(model.probabilities(x, model.pairs()), p, atol=1e-5)


def test_no_labels_or_rows(spark):
    docs = frame(spark, [(None, "katimo"), (None, None)])
    assert L.learn(docs) is None
    assert {r.lang_pred for r in L.identify(docs, None).collect()} == {"und"}
    assert L.identify(docs.limit(0), None).count() == 0


def test_pieces_change_nothing(monkeypatch):
    rng = np.random.default_rng(4)
    data = np.frombuffer(bytes(rng.integers(32, 127, 5000).tolist()), np.uint8)
    bounds = np.array([0, 0, 700, 3900, 3900, 5000])
    x, _, _ = L.windows(data, bounds)
    model = L.train(x, rng.integers(0, 2, len(x)), ["p", "q"], epochs=1)
    whole = L.verdicts(model, 5, data, bounds, model.pairs())
    monkeypatch.setattr(L, "PIECE", 512)
    cut = L.verdicts(model, 5, data, bounds, model.pairs())
    assert (whole[0] == cut[0]).all() and np.allclose(whole[1], cut[1])


def test_more_than_a_thousand_languages_are_learned(spark, monkeypatch):
    monkeypatch.setattr(L, "EPOCHS", 1)
    docs = spark.createDataFrame([(i, f"text {i} " * 3, f"l{i % 1100}") for i in range(3300)], "doc_id long, text string, lang string")
    model = L.learn(docs)
    assert len(model.langs) == len({i % 1100 for i in range(3300) if zlib.crc32(str(i).encode()) % 3 != 1}) > 1000


def test_the_stage_rejects_verdicts_that_are_mostly_wrong_and_names_languages(spark):
    rows = texts(150)
    rng = random.Random(8)
    mixed = [(rng.choice(list(VOWELS)), " ".join("".join(rng.choices(sum(VOWELS.values(), []), k=2)) for _ in range(30))) for _ in range(150)]
    docs = frame(spark, rows + mixed + [(None, "ka ti mo ka ti mo ka ti ka mo"), (None, "77 ...")])
    model = L.learn(docs)
    least = L.least_score(docs, model)
    held = {r.doc_id: (r.lang, r.lang_pred, r.score) for r in docs.select("doc_id", "lang").join(L.identify(docs, model), "doc_id").collect() if r.lang and zlib.crc32(str(r.doc_id).encode()) % 3 == 1}
    under = [a == b for a, b, s in held.values() if s < least]
    assert least > 0 and 2 * sum(under) < len(under)
    kept = {r.doc_id: r for r in L.drop_unknown(docs).collect()}
    assert kept[600].lang == "aa" and 601 not in kept
    assert sum(i in kept for i in range(450)) > 445 and sum(i in kept for i in range(450, 600)) < 120


def test_query_columns_and_folds(spark, tmp_path):
    rows = texts(40) + [(None, None), (None, ""), (None, "1 2"), (None, "ka ti " * 200_000)]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = L.op9_language_id(spark, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in got) == list(range(len(rows)))
    assert set(got[0].asDict()) == {"doc_id", "held_out", "lang_pred", "score"}
    model = L.learn(frame(spark, rows))
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        data = np.frombuffer((rows[r.doc_id][1] or "").encode(), np.uint8)
        best, score = L.verdicts(model, 1, data, np.array([0, len(data)]), model.pairs())
        assert r.lang_pred == ["und", *model.langs][best[0]] and abs(r.score - score[0]) < 1e-6
