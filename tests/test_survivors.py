"""Perimeters and ignitions that meet by name and date, and what is read for them."""

import datetime as dt

from cinderframe.operators import matching as M
from cinderframe.plans import burns

DAY = dt.datetime(2000, 1, 1)


def test_survivors_read_no_table_again(spark, sf):
    """Perimeters and ignitions of the pairs come from the stored pairs."""
    for df in burns.kept(spark, sf):
        assert "FileScan" not in df._jdf.queryExecution().executedPlan().toString()


def test_survivors_of_equal_survivors(spark, sf):
    large, points = M.large_perimeters(burns.perimeters(spark, sf), 0.0), burns.frame(spark, sf, "ignitions")
    met = M.date_band_join(large, points)
    for a, b in zip(M.survivors_of(met, large.columns, points.columns), M.survivors(large, points, met.select("perim_idx", "pt_idx"))):
        assert sorted(map(str, a.select(b.columns).collect())) == sorted(map(str, b.collect())) != []


def test_band_of_days(spark):
    """All gaps about the band's ends, at spans' ends too."""
    rows = [(d, DAY + dt.timedelta(days=d, hours=h)) for d in range(0, 40, 1) for h in (0, 13)]
    perims = spark.createDataFrame([(i, "Big Fire", t) for i, (_, t) in enumerate(rows)], "perim_idx long, perim_name string, ig_date timestamp_ntz")
    points = spark.createDataFrame([(i, "big-fire", t, t) for i, (_, t) in enumerate(rows)], "pt_idx long, point_name string, discovery timestamp_ntz, fireout timestamp_ntz")
    got = sorted((r.perim_idx, r.pt_idx) for r in M.date_band_join(perims, points).collect())
    # DuckDB's rule: abs(floor(seconds / 86400)) <= 2, of the time from ignition date to discovery.
    assert got == sorted((i, j) for i, (_, a) in enumerate(rows) for j, (_, b) in enumerate(rows) if abs((b - a).total_seconds() // 86400) <= 2)
