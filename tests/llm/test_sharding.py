import random
import zlib
from collections import defaultdict

import pytest

from cinderframe.llm.sharding import op5_sharding, shards

N = 4


def verify(texts, rows, n=N):
    """Sizes, gapless slots, whole groups, and bytes within one group of equal; groups over an even share stand alone."""
    assert sorted(r.doc_id for r in rows) == list(range(len(texts)))
    sizes = [len((t or "").encode()) + 1 for t in texts]
    by, groups, held = defaultdict(list), defaultdict(set), defaultdict(int)
    for r in rows:
        t = texts[r.doc_id]
        assert r["size"] == sizes[r.doc_id] and r.text_crc32 == zlib.crc32((t or "").encode())
        by[r.shard].append(r)
        groups[t or ""].add(r.shard)
        held[t or ""] += r["size"]
    for rs in by.values():
        assert sorted(r.slot for r in rs) == list(range(len(rs)))
    assert all(len(found) == 1 for found in groups.values())
    own, left = 0, sum(sizes)
    for b in sorted(held.values(), reverse=True)[: n - 1]:
        if b * (n - own) <= left:
            break
        own, left = own + 1, left - b
    over = {r.shard for r in rows if r.oversize}
    assert len(over) == own
    most = max([b for t, b in held.items() if not groups[t] & over], default=0)
    for s in set(range(n)) - over:
        assert abs(sum(r["size"] for r in by[s]) - left / (n - own)) <= most
    for s in over:
        assert len({texts[r.doc_id] for r in by[s]}) == 1


@pytest.mark.parametrize("hot", [0, 400, 3000])
def test_near_equal_bytes(documents, hot):
    texts = [f"text {i} é " * (1 + i * 7 % 23) for i in range(1500)] + ["same words"] * hot + [None, None, "", "x", "x"]
    verify(texts, shards(documents(texts), N).collect())


@pytest.mark.parametrize("copies", [2, 60])
def test_groups_just_below_a_shard_stay_whole(documents, copies):
    rng = random.Random(copies)
    texts = [t for i in range(190) for t in [f"{i} " + "".join(rng.choices("abc ", k=200))] * copies] + ["long " * 5000]
    rng.shuffle(texts)
    verify(texts, shards(documents(texts).repartition(7), 8).collect(), 8)


def test_one_text_only_and_empty(documents):
    texts = ["just this"] * 500
    verify(texts, shards(documents(texts), N).collect())
    assert shards(documents(texts).limit(0)).count() == 0
    assert [r.slot for r in shards(documents(["one"]), N).collect()] == [0]


def test_repeated_rows_and_null_ids(spark):
    df = spark.createDataFrame([(None, "a"), (None, "a"), (1, None), (1, None)], "doc_id long, text string")
    rows = shards(df, 2).collect()
    assert len(rows) == 4 and len({(r.shard, r.slot) for r in rows}) == 4


def test_query_on_a_table(spark, documents, tmp_path):
    texts = [f"{i % 70} ü" * (i % 9) for i in range(700)] + [None, "", "b " * 500_000]
    documents(texts).write.parquet(f"{tmp_path}/documents.parquet")
    rows = op5_sharding(spark, str(tmp_path)).collect()
    verify(texts, rows, 8)
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}
