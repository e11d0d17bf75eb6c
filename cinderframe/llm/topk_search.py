"""Exact top-k inner products, a block of documents at a time.

Vectors are taken as documents whose terms are their components. They are put in an order that brings like vectors together and cut into blocks of
neighbours; a block keeps the extremes of each term and a forward index, the terms of its documents. A query bounds each
block's scores by the sum of the terms' maxima, visits blocks in falling order of that bound and scores all documents of a block from its forward index,
until the bound falls below its k-th best score.

Queries are cut into tiles in the same order. Tiles meet the blocks' extremes first, which are small; each query's best-bounded blocks are scored, which
lifts its k-th score, and then a forward index is sent only to the tiles where some query's bound still reaches that.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from .tables import durable, read

#: Documents of a block, blocks whose extremes meet a tile together, blocks of a cell that a task scores, queries of a tile.
BLOCK, BOUNDS, CELL_BLOCKS, TILE = 128, 4096, 64, 512
#: Documents that each query is scored against first, and its best-bounded blocks that are scored next, so that its k-th best score is a good one before the rest.
SEEDS, PROBES = 2048, 2
#: Signs of random projections that make the order.
SIGNS = 14


def whole_vectors(vectors: DataFrame, id_col: str, vec_col: str, scale: int = 256) -> DataFrame:
    """(id, terms array<long>): floor(scale * component) of each row's vector if it has no null or non-finite components. Null ids take no part."""
    x = F.col(vec_col)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    terms = F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("long"))
    return vectors.where(F.col(id_col).isNotNull() & x.isNotNull() & (F.size(x) > 0)).where(~bad).select(F.col(id_col).alias("id"), terms.alias("terms"))


def _matrix(batch: pa.RecordBatch | pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dimension, ids, terms) of the rows of each dimension."""
    lists = batch.column("terms")
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    size = np.diff(lists.offsets.to_numpy())
    ids, flat = batch.column("id").to_numpy(), lists.flatten().to_numpy()
    start = np.cumsum(size) - size
    for d in np.unique(size).tolist():
        mine = np.flatnonzero(size == d)
        yield d, ids[mine], flat[start[mine][:, None] + np.arange(d)]


def blocks(terms: DataFrame, block: int = BLOCK, key: str = "block") -> DataFrame:
    """(dim, n, ids, forward, low, high, key): blocks of at most `block` neighbours, packed little-endian longs, and a number of each."""

    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = np.zeros(batch.num_rows, np.int64)
            size = np.diff(batch.column("terms").offsets.to_numpy())
            for d, _, x in _matrix(batch):
                plane = np.random.default_rng(d).normal(size=(d, SIGNS))
                code[size == d] = ((x @ plane > 0) * (1 << np.arange(SIGNS))).sum(axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(code), *batch.columns], ["code", "id", "terms"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left: list[pa.RecordBatch] = []

        def packed(rows: pa.Table) -> Iterator[tuple]:
            for d, ids, x in _matrix(rows):
                for a in range(0, len(ids), block):
                    part = x[a : a + block]
                    yield d, len(part), ids[a : a + block].tobytes(), part.tobytes(), part.min(axis=0).tobytes(), part.max(axis=0).tobytes()

        def out(rows: pa.Table) -> pa.RecordBatch:
            columns = list(zip(*packed(rows), strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int32(), pa.int32(), *[pa.binary()] * 4], strict=True)], ["dim", "n", "ids", "forward", "low", "high"])

        for batch in batches:
            left.append(batch.select(["id", "terms"]))
            if sum(b.num_rows for b in left) >= 16 * block:
                yield out(pa.Table.from_batches(left).combine_chunks())
                left = []
        if sum(b.num_rows for b in left):
            yield out(pa.Table.from_batches(left).combine_chunks())

    kind = dict(terms.dtypes)["id"]
    placed = durable(terms.mapInArrow(order, f"code long, id {kind}, terms array<long>"))
    placed = placed.repartitionByRange("code", "id").sortWithinPartitions("code", "id")
    return placed.mapInArrow(pack, "dim int, n int, ids binary, forward binary, low binary, high binary").withColumn(key, F.monotonically_increasing_id())


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T of longs, exactly: by doubles where all sums fit into them."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if a.shape[1] * float(np.abs(a).max()) * float(np.abs(b).max()) < 2**52:
        return np.rint(a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


class Best:
    """The k best (score, id) of each query, ties to smaller ids, each row of a repeated document for itself; `floor` is a score that k documents are known to reach."""

    def __init__(self, queries: np.ndarray, k: int, floor: np.ndarray):
        self.queries, self.k, self.floor = queries, k, floor.copy()
        self.score = np.full((len(queries), k), np.iinfo(np.int64).min)
        self.id = np.full((len(queries), k), np.iinfo(np.int64).max)

    def add(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """scores[i, j] of document ids[j] for query rows[i]."""
        i, j = np.nonzero((scores >= self.floor[rows][:, None]) & (ids[None, :] != self.queries[rows][:, None]))
        if not len(i):
            return
        met = np.unique(i)
        at = rows[met]
        q = np.r_[i, np.repeat(met, self.k)]
        s = np.r_[scores[i, j], self.score[at].ravel()]
        d = np.r_[ids[j], self.id[at].ravel()]
        order = np.lexsort((d, -s.astype(np.float64) if np.abs(s[s > np.iinfo(np.int64).min]).max(initial=0) < 2**52 else _falling(s), q))
        q, s, d = q[order], s[order], d[order]
        first = np.searchsorted(q, met)
        take = first[:, None] + np.arange(self.k)
        self.score[at], self.id[at] = s[take], d[take]
        self.floor[at] = np.maximum(self.floor[at], self.score[at, -1])


def _falling(s: np.ndarray) -> np.ndarray:
    """Numbers in the reverse order of longs, without overflow."""
    return np.bitwise_not(s)


def bounds(x: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """bounds[i, j]: what no document of block j can exceed for query i."""
    return product(np.maximum(x, 0), high) + product(np.minimum(x, 0), low)


def search_cell(best: Best, x: np.ndarray, bound: np.ndarray, index: list[tuple[np.ndarray, np.ndarray]]) -> int:
    """Brings the queries x through the blocks of a cell; returns how many query-block pairs were scored."""
    order = np.argsort(-bound, axis=1, kind="stable")
    live, scored = np.arange(len(x)), 0
    for nth in range(len(index)):
        b = order[live, nth]
        reach = bound[live, b] >= best.floor[live]
        live, b = live[reach], b[reach]
        if not len(live):
            break
        scored += len(live)
        for one in np.unique(b):
            mine = live[b == one]
            ids, terms = index[one]
            best.add(mine, ids, product(x[mine], terms))
    return scored


def _longs(column: pd.Series, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.int64).reshape(-1, width)


def _seeded(terms: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """asked with `floor`: the k-th best score of each query among SEEDS documents, which are sent with the code."""
    by_dim: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    seeds = terms.orderBy(F.xxhash64("id"), "id").limit(SEEDS).toPandas()
    for d, g in seeds.groupby(seeds["terms"].map(len)) if len(seeds) else []:
        by_dim[int(d)] = g["id"].to_numpy(), np.stack(g["terms"].to_numpy()).astype(np.int64)
    schema = "tile long, dim int, n int, ids binary, forward binary, floors binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            floors = []
            for d, ids, forward in zip(batch.column("dim").to_pylist(), batch.column("ids").to_pylist(), batch.column("forward").to_pylist(), strict=True):
                q = np.frombuffer(ids, np.int64)
                part = Best(q, k, np.full(len(q), np.iinfo(np.int64).min))
                if d in by_dim:
                    part.add(np.arange(len(q)), by_dim[d][0], product(np.frombuffer(forward, np.int64).reshape(-1, d), by_dim[d][1]))
                floors.append(part.floor.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("tile", "dim", "n", "ids", "forward")] + [pa.array(floors, pa.binary())], ["tile", "dim", "n", "ids", "forward", "floors"])

    return asked.mapInArrow(run, schema)


def _bounded(tiles: DataFrame, extremes: DataFrame, chosen: str, least: int) -> DataFrame:
    """(dim, tile, block) of the pairs to be scored, from the blocks' extremes alone.

    chosen "probes": for each query its `least` blocks of the largest bounds in every group of extremes; "rest": all whose bound reaches a query's floor.
    """

    def run(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(held):
            return pd.DataFrame({"dim": np.zeros(0, np.int32), "tile": np.zeros(0, np.int64), "block": np.zeros(0, np.int64)})
        dim, low, high = int(held["dim"].iloc[0]), _longs(held["low"], int(held["dim"].iloc[0])), _longs(held["high"], int(held["dim"].iloc[0]))
        out = []
        for tile, forward, floors in zip(asked["tile"], asked["forward"], asked["floors"], strict=True):
            bound = bounds(np.frombuffer(forward, np.int64).reshape(-1, dim), low, high)
            reach = bound >= np.frombuffer(floors, np.int64)[:, None]
            if chosen == "probes":
                top = np.zeros_like(reach)
                np.put_along_axis(top, np.argsort(-bound, axis=1, kind="stable")[:, :least], True, axis=1)
                reach &= top
            out.append(pd.DataFrame({"dim": np.int32(dim), "tile": np.int64(tile), "block": held["block"].to_numpy()[reach.any(axis=0)]}))
        return pd.concat(out)

    return tiles.groupBy("dim", "some", "part").cogroup(extremes.groupBy("dim", "some", "part")).applyInPandas(run, "dim int, tile long, block long")


def _scored(tiles: DataFrame, index: DataFrame, pairs: DataFrame, k: int, cell_blocks: int) -> DataFrame:
    """(tile, nth, id, score): for each query the k best documents of each cell of its tile's pairs."""
    counts = pairs.groupBy("tile").agg(F.count("*").alias("blocks"))
    dealt = pairs.join(counts, "tile").withColumn("cell", F.pmod(F.xxhash64("block"), F.ceil(F.col("blocks") / cell_blocks)).cast("int")).select("dim", "tile", "block", "cell")
    right = dealt.join(index.select("block", "ids", "forward", "low", "high"), "block")
    left = tiles.join(dealt.select("tile", "cell").distinct(), "tile").select(*[F.col(c).alias(c) for c in ("dim", "tile", "cell", "ids", "forward", "floors")])

    def run(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(held):
            return pd.DataFrame({"tile": np.zeros(0, np.int64), "nth": np.zeros(0, np.int32), "id": np.zeros(0, np.int64), "score": np.zeros(0, np.int64)})
        dim = int(held["dim"].iloc[0])
        x = np.frombuffer(asked["forward"].iloc[0], np.int64).reshape(-1, dim)
        best = Best(np.frombuffer(asked["ids"].iloc[0], np.int64), k, np.frombuffer(asked["floors"].iloc[0], np.int64))
        parts = [(np.frombuffer(i, np.int64), np.frombuffer(f, np.int64).reshape(-1, dim)) for i, f in zip(held["ids"], held["forward"], strict=True)]
        search_cell(best, x, bounds(x, _longs(held["low"], dim), _longs(held["high"], dim)), parts)
        q, j = np.nonzero(best.id < np.iinfo(np.int64).max)
        return pd.DataFrame({"tile": np.full(len(q), asked["tile"].iloc[0]), "nth": q.astype(np.int32), "id": best.id[q, j], "score": best.score[q, j]})

    key = ["dim", "tile", "cell"]
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(run, "tile long, nth int, id long, score long")


def _lifted(tiles: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """tiles with each query's floor lifted to its k-th best score found."""
    rank = Window.partitionBy("tile", "nth").orderBy(F.desc("score"))
    kth = found.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") == k).groupBy("tile").agg(F.collect_list(F.struct("nth", "score")).alias("kth"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            floors = []
            for old, new in zip(batch.column("floors").to_pylist(), batch.column("kth").to_pylist(), strict=True):
                floor = np.frombuffer(old, np.int64).copy()
                at = np.array([r["nth"] for r in new or []], np.int64)
                floor[at] = np.maximum(floor[at], np.array([r["score"] for r in new or []], np.int64))
                floors.append(floor.tobytes())
            keep = [c for c in batch.schema.names if c not in ("floors", "kth")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(floors, pa.binary())], [*keep, "floors"])

    joined = tiles.join(kth, "tile", "left").select("tile", "dim", "n", "ids", "forward", "floors", "kth")
    return joined.mapInArrow(run, "tile long, dim int, n int, ids binary, forward binary, floors binary")


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", block: int = BLOCK, cell_blocks: int = CELL_BLOCKS, tile: int = TILE) -> DataFrame:
    """(query_id, rank, id, score): the k vectors of the largest integer inner product for each query, ties to smaller ids, all if there are fewer.

    Ids are longs; a vector with the query's id is no candidate. Each row of a repeated vector is a candidate of its own; a query that is repeated as a
    whole is asked once, and rows of one id and different vectors are queries of their own. Only vectors of the query's dimension are compared. Vectors
    that are null, empty or hold null or non-finite components take no part, nor do null ids. Empty inputs give no rows. The bounds skip blocks, never a document that belongs to the result.
    """
    terms = durable(whole_vectors(vectors, id_col, vec_col))
    index = durable(blocks(terms, block))
    tiles = blocks(durable(whole_vectors(queries, id_col, vec_col).distinct()), tile, "tile").select("tile", "dim", "n", "ids", "forward")
    tiles = durable(_seeded(terms, tiles, k))
    groups = max(1, -(-index.count() // BOUNDS))
    # Each group of extremes meets each tile; tiles are dealt to parts so that a task holds few of them, and a group of extremes goes to each part once.
    parts = max(1, -(-tiles.count() // 16))
    extremes = index.select("dim", "block", "low", "high", F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int").alias("some")).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    everywhere = lambda t: t.select("dim", "tile", "forward", "floors", F.pmod(F.xxhash64("tile"), F.lit(parts)).cast("int").alias("part"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("some"))
    probes = durable(_bounded(everywhere(tiles), extremes, "probes", PROBES))
    first = durable(_scored(tiles, index, probes, k, cell_blocks))
    tiles = durable(_lifted(tiles, first, k))
    rest = _bounded(everywhere(tiles), extremes, "rest", 0).join(probes, ["dim", "tile", "block"], "left_anti")
    found = first.unionByName(_scored(tiles, index, durable(rest), k, cell_blocks))
    order = Window.partitionBy("tile", "nth").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    named = tiles.select("tile", "ids").mapInArrow(_query_ids, "tile long, nth int, query_id long")
    return ranked.join(named, ["tile", "nth"]).select("query_id", "rank", "id", "score")


def _query_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for tile, ids in zip(batch.column("tile").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            q = np.frombuffer(ids, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(q), tile)), pa.array(np.arange(len(q), dtype=np.int32)), pa.array(q)], ["tile", "nth", "query_id"])


def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    found = search(vectors, vectors.where("vec_id % 50 = 0"))
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score")


ORACLE = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as e
  from embeddings
  where embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select q.vec_id as query_id, q.e, c.vec_id, cast(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) as bigint) as score
  from (select distinct vec_id, e from v where vec_id % 50 = 0) q join v c on q.vec_id <> c.vec_id and len(q.e) = len(c.e)
)
select query_id, cast(row_number() over (partition by query_id, e order by score desc, vec_id) as integer) as rank, vec_id, score
from s
qualify rank <= 5
"""
