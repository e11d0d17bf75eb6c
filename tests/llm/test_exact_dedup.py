import hashlib
import re
from collections import defaultdict

import duckdb

from cinderframe.llm.exact_dedup import ORACLE, drop_copies, exact_groups, frequent, op10_exact_dedup, shrink

TEXTS = ["a b", "ab", None, "", " \n\t", "a  b", "c", "C", "ab ", "x" * 50_000, "x" * 49_999 + " x", "é e", "ée"] + ["hot text"] * 40


def brute(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), i))
    return {i: (min(g)[1], len(g), hashlib.sha256(k.encode()).digest()) for k, g in groups.items() for _, i in g}


def test_groups_are_those_of_brute_force(documents):
    rows = exact_groups(documents(TEXTS), counters=4).collect()
    assert {r.doc_id: (r.keep_id, r.group_size, bytes(r.digest)) for r in rows} == brute(enumerate(TEXTS))
    assert all(r.kept == (r.doc_id == r.keep_id) for r in rows)


def test_repeated_rows_keep_one(spark, documents):
    twice = documents(TEXTS).unionByName(documents(TEXTS))
    assert sum(r.kept for r in exact_groups(twice).collect()) == len(set(k for k in map(lambda x: x[2], brute(enumerate(TEXTS)).values())))
    left = drop_copies(twice)
    assert left.columns == twice.columns
    assert left.count() == drop_copies(documents(TEXTS)).count()


def test_empty_and_null_ids(spark, documents):
    none = documents(TEXTS).limit(0)
    assert exact_groups(none).count() == 0 and drop_copies(none).count() == 0
    odd = spark.createDataFrame([(None, "a"), (3, "a"), (None, None)], "doc_id long, text string")
    assert sorted((r.doc_id is None, r.keep_id, r.kept) for r in exact_groups(odd).where("digest is not null").collect() if r.group_size == 2) == [(False, 3, True), (True, 3, False)]


def test_summary_holds_every_frequent_key(spark):
    keys = ["a"] * 40 + ["b"] * 30 + [f"k{i}" for i in range(60)]
    df = spark.createDataFrame([(bytearray(k.encode()),) for k in keys], "digest binary").repartition(5)
    assert {b"a", b"b"} <= {bytes(r.digest) for r in frequent(df, 4).collect()}
    assert shrink({b"a": 5, b"b": 1, b"c": 1}, 2) == {b"a": 4}


def test_query_equals_its_sql(spark, documents, tmp_path):
    rows = documents([*TEXTS, "b " * 500_000])
    rows.unionByName(rows.where("doc_id % 3 = 0")).write.parquet(f"{tmp_path}/documents.parquet")
    duckdb.sql(f"create or replace temp view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    got = op10_exact_dedup(spark, str(tmp_path)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(duckdb.sql(ORACLE).fetchall())
