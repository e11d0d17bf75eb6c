import random

import corpus_pipeline as P
from cinderframe.llm import language_id
from tests.llm.test_near_copies import brute_roots
from tests.llm.test_suffix_dedup import brute


def corpus():
    rng = random.Random(2)
    words = {"aa": "ka ti mo ru".split(), "bb": "ßz ör üng ten".split()}
    text = lambda lang, n: " ".join("".join(rng.choices(words[lang], k=5)) for _ in range(n))
    rows = [(lang, text(lang, rng.choice([30, 120, 300]))) for _ in range(60) for lang in words]
    passage = text("aa", 70)
    rows += [("aa", f"{text('aa', 200)} {passage} {text('aa', 200)}") for _ in range(5)]
    rows += rows[:10] + [(lang, t + "  ") for lang, t in rows[10:20]] + [(lang, t.replace("a", "A")) for lang, t in rows[20:30]]
    return rows + [(None, None), (None, ""), (None, "123 456")]


def test_run_equals_brute_force(spark, tmp_path):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    packs = P.run(spark, str(tmp_path)).collect()
    model = language_id.learn(docs)
    least = language_id.least_score(docs, model)
    left = {r.doc_id: rows[r.doc_id][1] for r in language_id.identify(docs, model).collect() if r.lang_pred != "und" and r.score >= least}
    best = {}
    for i, t in left.items():
        k = "".join(t.split())
        best[k] = min(best.get(k, (1, 0)), (-len(t), i))
    left = {i: left[i] for _, i in sorted(best.values(), key=lambda x: x[1])}
    ids = list(left)
    root = brute_roots([left[i] for i in ids])
    left = {i: left[i] for k, i in enumerate(ids) if root[k] == k}
    ids = list(left)
    gone = brute(list(left.values()), 50)[True]
    want = {i: [w for n, w in enumerate(left[i].split()) if n not in gone[k]] for k, i in enumerate(ids)}
    want = {i: " ".join(w) for i, w in want.items() if w}
    got = {}
    for r in packs:
        got[r.doc_id] = got.get(r.doc_id, 0) + r.tokens
    assert set(got) == set(want)
    assert all(abs(got[i] - len(t.encode()) - 1) <= 2 for i, t in want.items())
    assert len(got) < len(rows) - 20


def test_stages_keep_the_columns(spark, documents):
    docs = documents(["ka ti " * 40, None, "", "ka ti " * 40 + "mo"])
    for name, stage in P.STAGES[:-1]:
        assert stage(spark, docs, "").dtypes == docs.dtypes, name
        assert stage(spark, docs.limit(0), "").count() == 0, name


def test_stages_on_awkward_rows(spark):
    """Null ids, repeated rows, ids that repeat with other texts, and columns of the stages' own names."""
    passage = " ".join(f"w{i}" for i in range(80))
    rows = [(1, passage), (1, passage), (1, "another text " * 30), (None, passage + " end"), (None, None), (2, None), (3, ""), (4, passage.upper()), (5, "x y " * 100_000)]
    clash = "__id long, __doc long, __cuts long, __key long, __row long, __digest string, __rank long, __again long, __node long, __want string"
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), *[7] * 5, "d", *[7] * 3, "w") for i, t in rows], f"doc_id long, text string, lang string, source string, n_chars long, {clash}")
    kept = {"exact dedup": [(None, passage + " end"), (1, "another text " * 30), (1, passage), (2, None), (4, passage.upper()), (5, "x y " * 100_000)]}
    for name, stage in P.STAGES[1:-1]:
        out = stage(spark, docs, "")
        assert out.dtypes == docs.dtypes, name
        got = out.collect()
        assert {r["__rank"] for r in got} == {7} and {r["__digest"] for r in got} == {"d"}, name
        if name in kept:
            assert sorted(((r.doc_id or 0, r.text or "") for r in got)) == sorted((i or 0, t or "") for i, t in kept[name])
    assert {r.doc_id for r in P.packs(spark, docs, "").collect()} == {1, 2, 3, 4, 5, None}
