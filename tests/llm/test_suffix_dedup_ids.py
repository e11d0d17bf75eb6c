from cinderframe.llm import suffix_dedup as S

L, K = 10, 3


def text(name, n):
    return " ".join(f"{name}{i}" for i in range(n))


def test_rows_that_share_an_id_and_differ_in_text(spark):
    passage = text("p", 15)
    rows = [(1, f"{passage} {text('a', 40)}"), (1, f"{passage} {text('b', 5)}"), (2, f"{text('c', 60)} {passage}"), (2, text("d", 12)), (3, text("e", 20)), (None, passage)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = {(r.doc_id, w) for r in S.remove_repeats(docs, L, K).collect() for w in r.text.split()}
    assert left == {(i, w) for i, t in rows for w in t.split()} - {(2, w) for w in passage.split()}
    out = S.remove_repeats(docs, L, K).where("doc_id = 1").collect()
    assert sum(passage in r.text for r in out) == 1 and len(out) == 2
    found = sorted((r.doc, r.removed, r.start, r.end, r.other) for r in S.repeats(docs, L, K).collect())
    assert [x[:4] for x in found] == [(1, False, 0, 15), (1, True, 0, 15), (2, True, 60, 75)]
    assert {x[4] for x in found} <= {1, 2}


def test_a_row_stored_twice_has_no_span(spark):
    docs = spark.createDataFrame([(1, text("a", 30)), (1, text("a", 30)), (2, text("b", 30))], "doc_id long, text string")
    assert S.repeats(docs, L, K).count() == 0
    assert S.remove_repeats(docs, L, K).count() == 3
