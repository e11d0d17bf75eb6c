"""Unions of a few simple polygons, many keys at a time, against the edges on tiles."""

import random

import numpy as np
from pyspark.sql import functions as F

from cinderframe.operators import dissolve, small_unions

RINGS = "case_id long, rings array<array<struct<x:double,y:double>>>"


def diamond(x, y, h):
    return [(x + h, y), (x, y + h), (x - h, y), (x, y - h)]


def table(spark, rows):
    return spark.createDataFrame([(c, r and [[tuple(None if v is None else float(v) for v in p) for p in ring] for ring in r]) for c, r in rows], RINGS)


def edges(df):
    return sorted((r.case_id, *[round(v, 5) + 0.0 for v in (r.x1, r.y1, r.x2, r.y2)]) for r in df.collect())


def some_rows():
    rng = random.Random(3)
    rows = []
    for case in range(30):
        for _ in range(rng.randint(1, 8)):  # corners on a grid of few places, so edges touch, lie on each other and are equal
            ring = diamond(rng.randint(0, 6), rng.randint(0, 6), rng.randint(1, 3))
            rows.append((case, [ring[::-1] if rng.random() < 0.5 else ring]))
    for case in range(30, 40):
        for _ in range(6):
            x, y = rng.uniform(0, 10), rng.uniform(0, 10)
            rows.append((case, [[(x, y), (x + rng.uniform(1, 9), y + rng.uniform(-2, 2)), (x + rng.uniform(-2, 2), y + rng.uniform(1, 9))]]))
    return rows


def test_equal_to_tiles(spark):
    df = table(spark, some_rows())
    each = df.distinct().withColumn("part", F.xxhash64("rings"))
    got = dissolve.union_boundary(df, 2.0)
    assert "MapInArrow" in got._jdf.queryExecution().executedPlan().toString()  # no pair of edges is a row
    assert edges(got) == edges(dissolve._on_tiles(each, 2.0, "case_id", 6))


def test_keys_that_are_not_simple(spark):
    """Large keys, holes and places that are not known go by tiles, and nothing is lost beside them."""
    rows = [
        (1, [diamond(0, 0, 1)]), (2, [diamond(0, 0, 4), diamond(0, 0, 2)]), (2, [diamond(20, 0, 1)]),
        *[(3, [diamond(10 * i, 0, 1)]) for i in range(20)],
        (4, []), (4, [diamond(0, 0, 1)]), (5, [[]]), (6, [[(0, 0), (1, 1)]]), (7, None), (None, [diamond(0, 0, 1)]),
        (8, [[(float("nan"), 0), (1, 1), (2, 0)]]), (8, [diamond(50, 50, 1)]), (9, [[(0, 0), (2, 0), (None, 1)]]), (9, [diamond(9, 9, 1)]),
    ]
    got = {r.case_id: (round(r.area, 6), r.edges) for r in dissolve.union_area(dissolve.union_boundary(table(spark, rows), 2.0)).where("case_id < 8").collect()}
    assert got == {1: (2.0, 4), 2: (26.0, 12), 3: (40.0, 80), 4: (2.0, 4)}


def test_keys_across_batches(spark):
    """A key whose polygons come in several batches, and many keys in one."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        rows = [(c, [diamond(10 * i, c, 1)]) for c in range(40) for i in range(1 + c % 9)]
        got = {r.case_id: r.area for r in dissolve.union_area(dissolve.union_boundary(table(spark, rows), 2.0)).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == {c: 2.0 * (1 + c % 9) for c in range(40)}


def test_equal_rows_of_one_hash():
    a = np.array([5, 7, 5, 7, 5], np.int64)
    order, starts = small_unions._same(a, a.astype(float))
    assert [set(a[order][i:j]) for i, j in zip(starts, [*starts[1:], 5])] in ([{5}, {7}], [{7}, {5}])
