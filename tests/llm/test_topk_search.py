import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from cinderframe.llm import topk_search as K


def brute(rows, queries, k):
    """Sorted (query_id, rank, id, score): every row is a candidate, a query that is repeated as a whole is asked once."""
    whole = [(i, tuple(int(np.floor(256 * float(np.float32(x)))) for x in v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, x in {r for r in whole if r[0] in queries}:
        found = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in whole if i != q and len(x) == len(y))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found[:k])]
    return sorted(out)


@pytest.mark.parametrize("block,cell,tile", [(4, 2, 3), (256, 64, 2048)])
def test_equals_brute_force(spark, block, cell, tile):
    rng = np.random.default_rng(6)
    centres = rng.normal(0, 0.3, (5, 6))
    rows = [(i, (centres[i % 5] + rng.normal(0, 0.05, 6)).astype(np.float32).tolist()) for i in range(160)]
    rows += [(200 + i, rows[3][1]) for i in range(12)]  # ties
    rows += [rows[1], rows[1], rows[10], (20, rows[7][1])]  # candidates and a query twice, another vector of one id
    rows += [(300, None), (301, []), (302, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (303, [float("nan")] * 6), (304, [float("inf")] + [0.0] * 5), (305, [0.5, 0.5]), (306, [0.25, -1.0]), (None, [0.1] * 6), (0, rows[0][1])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int").repartition(3)
    queries = [i for i in range(0, 400, 10)] + [305]
    asked = df.where(df.vec_id.isin(queries))
    got = sorted((r.query_id, r["rank"], r.id, r.score) for r in K.search(df, asked, 5, block=block, cell_blocks=cell, tile=tile).collect())
    assert got == brute(rows, queries, 5)


def test_fewer_than_k_and_empty(spark):
    df = spark.createDataFrame([(0, [0.5]), (1, [-0.5]), (2, [0.5])], "vec_id long, embedding array<float>")
    assert sorted((r.query_id, r["rank"], r.id, r.score) for r in K.search(df, df.where("vec_id = 0")).collect()) == [(0, 1, 2, 128 * 128), (0, 2, 1, -128 * 128)]
    assert K.search(df.limit(0), df).count() == 0 and K.search(df, df.limit(0)).count() == 0


def test_bounds_skip_blocks():
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.integers(-5, 5, (64, 8)) + 100 * np.eye(8, dtype=int)[c] for c in range(8)])
    parts = [(np.arange(a, a + 64), x[a : a + 64]) for a in range(0, 512, 64)]
    best = K.Best(np.arange(512), 3, np.full(512, np.iinfo(np.int64).min))
    scored = K.search_cell(best, x, K.bounds(x, np.stack([p.min(axis=0) for _, p in parts]), np.stack([p.max(axis=0) for _, p in parts])), parts)
    assert scored < 512 * 8 / 4
    s = x @ x.T
    np.fill_diagonal(s, -(10**9))
    assert (best.score == -np.sort(-s, axis=1)[:, :3]).all()
    big = np.array([[2**40, -3], [7, 2**31]])
    assert (K.product(big, np.array([[5, 2**22]])) == big @ np.array([[5], [2**22]])).all()


def test_query_equals_its_sql(spark, tmp_path):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(0, 1, 4).astype(np.float32).tolist()) for i in range(201)]
    rows += [rows[0], rows[1], rows[1], (None, [1.0] * 4), (400, None), (450, [None, 1.0, 1.0, 1.0]), (500, rows[2][1])]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    duckdb.sql(f"create or replace temp view embeddings as select * from '{tmp_path}/embeddings.parquet/*.parquet'")
    got = K.op1_topk_search(spark, str(tmp_path)).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(map(tuple, got)) == sorted(duckdb.sql(K.ORACLE).fetchall())


def test_forward_indexes_go_where_bounds_reach(spark):
    """With as many clusters as blocks, pairs that are sent grow with the tiles and not with tiles times blocks."""
    sent = []
    for clusters in (8, 32):
        rng = np.random.default_rng(clusters)
        centres = rng.normal(0, 1, (clusters, 16))
        df = spark.createDataFrame([(i, (20 * centres[i % clusters] + rng.normal(0, 0.1, 16)).tolist()) for i in range(clusters * 32)], "vec_id long, embedding array<double>")
        terms = K.durable(K.whole_vectors(df, "vec_id", "embedding"))
        index = K.durable(K.blocks(terms, 32))
        tiles = K.durable(K._lifted(K._seeded(terms, K.blocks(terms, 32, "tile"), 5), spark.createDataFrame([], "tile long, nth int, id long, score long"), 5))
        one = F.lit(0)
        pairs = K._bounded(tiles.withColumns({"some": one, "part": one}), index.withColumns({"some": one, "part": one}), "rest", 0)
        sent.append(pairs.count() / (tiles.count() * index.count()))
    assert sent[1] < 0.6 * sent[0]
