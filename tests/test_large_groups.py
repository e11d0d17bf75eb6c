"""Operators that no large group, far place or long chain may slow: nearest points, places and medians within groups, coarse grids."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cinderframe.folders import medians, numbered_within
from cinderframe.operators.grids import coarsened
from cinderframe.operators.nearest import near_leaves, nearest_point


def brute(grid, places):
    out = {}
    for case, x, y in places:
        if x is None:
            continue
        d = [((gx - x) * (gx - x) + (gy - y) * (gy - y), i) for i, gx, gy in grid if gx is not None]
        out[case] = min(d)
    return out


def test_nearest_of_a_shared_grid_meets_few_pairs(spark):
    rng = np.random.default_rng(3)
    grid = [(i, float(i % 100), float(i // 100)) for i in range(10_000)] + [(10_000, 5000.0, -3000.0), (10_001, None, 1.0), (10_002, 5000.0, -3000.0)]
    places = [(k, float(x), float(y)) for k, (x, y) in enumerate(rng.uniform(-30, 130, (60, 2)))] + [(60, 4000.0, -2500.0), (61, 2.5, 2.5), (62, None, 0.0), (63, 1e6, 1e6)]
    g, p = spark.createDataFrame(grid, "point_id long, lon double, lat double"), spark.createDataFrame(places, "case_id long, lon0 double, lat0 double")
    # One far point makes tiles of the default width coarse, so their width is given.
    points, kept, keys = near_leaves(g, p, 4.0)
    assert kept.join(points, keys).count() < 0.01 * len(grid) * len(places)
    for base in (None, 4.0):
        got = {r.case_id: (r.d2, r.point_id) for r in nearest_point(g, p, base).collect()}
        assert got == brute(grid, places)


def test_nearest_of_each_cases_grid(spark):
    rng = np.random.default_rng(4)
    rows = [(c, i, float(x), float(y)) for c in range(3) for i, (x, y) in enumerate(rng.integers(0, 9, (200, 2)))]
    places = [(c, 4.5, 4.5) for c in range(4)]
    got = nearest_point(spark.createDataFrame(rows, "case_id long, point_id long, lon double, lat double"), spark.createDataFrame(places, "case_id long, lon0 double, lat0 double"), 1.0)
    want = {c: brute([r[1:] for r in rows if r[0] == c], [(c, 4.5, 4.5)])[c] for c in range(3)}
    assert {r.case_id: (r.d2, r.point_id) for r in got.collect()} == want


def test_nearest_without_points_or_places(spark):
    g, p = spark.createDataFrame([], "point_id long, lon double, lat double"), spark.createDataFrame([(1, 0.0, 0.0)], "case_id long, lon0 double, lat0 double")
    assert nearest_point(g, p).count() == 0
    one = spark.createDataFrame([(7, 3.0, 4.0)], "point_id long, lon double, lat double")
    assert [tuple(r) for r in nearest_point(one, p).collect()] == [(1, 7, 25.0)]
    assert nearest_point(one, p.limit(0)).count() == 0


@pytest.fixture(scope="module")
def groups(spark):
    """A group of most rows, small ones, a null one, repeated values, nulls."""
    rng = np.random.default_rng(5)
    rows = [("big", int(i), float(v)) for i, v in enumerate(rng.integers(0, 40, 3000))]
    rows += [("two", 1, 1.0), ("two", 2, 4.0), ("one", 1, -2.5), ("none", 1, None), (None, 1, 3.0), (None, 2, 5.0), (None, 3, None)]
    return rows


def test_places_within_groups(spark, groups):
    df = spark.createDataFrame(groups, "g string, i long, v double")
    got = sorted((str(r.g), r.nth, r.i) for r in numbered_within(df, ["g"], "v", "i").collect())
    want = []
    for g in {r[0] for r in groups}:
        own = sorted((r for r in groups if r[0] == g), key=lambda r: (r[2] is not None, r[2] or 0.0, r[1]))
        want += [(str(g), n, r[1]) for n, r in enumerate(own, 1)]
    assert got == sorted(want)


def test_medians_of_groups(spark, groups):
    df = spark.createDataFrame(groups, "g string, i long, v double").withColumn("w", F.col("i") * 2.0)
    got = {(r.g, r.column): r["median"] for r in medians(df, ["g"], ["v", "w"]).collect()}
    frame = pd.DataFrame(groups, columns=["g", "i", "v"]).astype({"v": float}).assign(w=lambda d: d.i * 2.0)
    want = {}
    for g, d in frame.groupby("g", dropna=False):
        for c in ("v", "w"):
            if d[c].notna().any():
                want[None if pd.isna(g) else g, c] = float(d[c].median())
    assert got == want
    assert medians(df.limit(0), ["g"], ["v"]).count() == 0


def test_a_coarse_grid_covers_its_source():
    assert coarsened((500.0, 1300.0, 30.0, 10, 9)) == (500.0, 1300.0, 120.0, 3, 3)
    assert coarsened((0.0, 0.0, 30.0, 8, 1), 4) == (0.0, 0.0, 120.0, 2, 1)
