"""Small cases worked by hand, and properties."""

import datetime as dt
import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cinderframe import config
from cinderframe.functions import geometry as G
from cinderframe.functions import projections as P
from cinderframe.functions import text as X
from cinderframe.operators import barriers as B
from cinderframe.operators import cases as C
from cinderframe.operators import dating as D
from cinderframe.operators import grids
from cinderframe.operators import matching as M
from cinderframe.operators import reports as R
from cinderframe.operators import runlog as L
from cinderframe.operators import scoring as S
from cinderframe.operators import weather as W
from cinderframe.schema import require_columns
from cinderframe.sources import tables as T

DAY = dt.datetime(2024, 7, 1)


def at(days=0.0, seconds=0):
    return DAY + dt.timedelta(days=days, seconds=seconds)


def test_counts_and_scores(spark):
    masks = spark.createDataFrame([(1, "m", c < 2, r < 2) for r in range(3) for c in range(3)], "case_id int, model string, observed boolean, simulated boolean")
    row = S.with_scores(S.confusion(masks), 1.0).first()
    assert (row.tp, row.fp, row.fn, row.tn) == (4, 2, 2, 1)
    assert row.jaccard == 0.5 and abs(row.sorensen - 2 / 3) < 1e-12 and abs(row.kappa) < 1e-12


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.booleans(), st.booleans()), min_size=1, max_size=30))
def test_score_properties(cells):
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    row = S.with_scores(S.confusion(spark.createDataFrame([(1, "m", o, s) for o, s in cells], "case_id int, model string, observed boolean, simulated boolean"))).first()
    assert row.tp + row.fp + row.fn + row.tn == len(cells)
    assert 0 <= row.jaccard <= row.sorensen <= 1


def test_nothing_burned_scores_zero(spark):
    masks = spark.createDataFrame([(1, "m", False, False)], "case_id int, model string, observed boolean, simulated boolean")
    row = S.with_scores(S.confusion(masks)).first()
    assert (row.jaccard, row.sorensen, row.kappa, row.ratio_of_areas) == (0, 0, 0, 0)


@pytest.mark.parametrize("value,want", [(None, False), (float("nan"), False), (-9999.0, False), (0.5, False), (1.0, True)])
def test_burned(spark, value, want):
    assert spark.createDataFrame([(value,)], "v double").select(S.burned(F.col("v"))).first()[0] is want


def test_date_band_is_not_symmetric(spark):
    perims = spark.createDataFrame([(1, "Big Creek", DAY, 6000.0)], "perim_idx long, perim_name string, ig_date timestamp_ntz, acres double")
    days = [-2, -2.5, 2.9, 3, 0]
    points = spark.createDataFrame([(i, "BIG-creek!", at(d), at(d + 9), 0.0, 0.0) for i, d in enumerate(days)] + [(9, "big creek", DAY, None, 0.0, 0.0)], "pt_idx long, point_name string, discovery timestamp_ntz, fireout timestamp_ntz, x double, y double")
    assert sorted(r.pt_idx for r in M.date_band_join(perims, points).collect()) == [0, 2, 4]


def test_name_keys(spark):
    df = spark.createDataFrame([("Un-Named",), ("a b-1!",), ("***",), (None,)], "n string")
    assert [r[0] for r in df.select(X.name_key(F.col("n"))).collect()] == [None, "AB1", "", None]


def test_long_case_ids_stay(spark):
    assert [r[0] for r in spark.createDataFrame([(7,), (123456,)], "n long").select(X.case_id(F.col("n"))).collect()] == ["00007", "123456"]


SQUARE_WITH_HOLE = [[(0, 0), (10, 0), (10, 10), (0, 10)], [(4, 4), (4, 6), (6, 6), (6, 4)]]
RINGS = "array<array<struct<x:double,y:double>>>"


def polygons(spark, rings):
    return spark.createDataFrame([(1, [[(float(x), float(y)) for x, y in ring] for ring in rings])], f"perim_idx long, rings {RINGS}")


def test_within_a_square_with_a_hole(spark):
    points = spark.createDataFrame([(1, 5.0, 0.0), (2, 5.0, 5.0), (3, 2.0, 2.0), (4, 10.0, 10.0), (5, 4.0, 5.0), (6, 11.0, 2.0)], "pt_idx long, x double, y double")
    found = G.points_in_polygons(points, polygons(spark, SQUARE_WITH_HOLE), 3.0)
    assert [r.pt_idx for r in found.collect()] == [3]
    assert polygons(spark, SQUARE_WITH_HOLE).select(G.shoelace(G.edges_of(F.col("rings")))).first()[0] == 96


def test_mask_by_cell_centre(spark):
    got = {(r.row_no, r.col_no) for r in grids.polygon_mask(polygons(spark, SQUARE_WITH_HOLE), 0.0, 12.0, 1.0, 12, 12).collect()}
    want = {(r, c) for r in range(12) for c in range(12) if c < 10 and r >= 2 and not (4 <= c < 6 and 4 <= 11 - r < 6)}
    assert got == want


def test_chain_breaks_after_a_gap(spark):
    hits = spark.createDataFrame([(1, at(0)), (1, at(7)), (1, at(14, 1)), (1, at(15))], "case_id int, sat_ts timestamp_ntz")
    row = D.chains(hits, 7).first()
    assert row.chain_end == at(7) and row.n == 2


def test_cover_counts_each_cell_once(spark):
    hits = spark.createDataFrame([(1, at(0), 0.0, 0.0), (1, at(1), 0.0, 0.0), (1, at(2), 1000.0, 0.0)], "case_id int, sat_ts timestamp_ntz, x double, y double")
    curve = [(r.sat_ts, r.area_m2) for r in D.coverage_curve(hits).orderBy("sat_ts").collect()]
    assert [t for t, _ in curve] == [at(0), at(1), at(2)] and curve[0][1] == curve[1][1] and curve[2][1] == 2 * curve[0][1]
    assert curve[0][1] == 2500 * sum(math.hypot(u * 50 + 25, v * 50 + 25) <= 200 for u in range(-5, 5) for v in range(-5, 5))
    half = D.time_to_fraction(D.coverage_curve(hits), hits, 0.5).first()
    assert half.reached == at(0)


def test_event_end_and_gate(spark):
    df = spark.createDataFrame([(at(0), at(1), None), (at(0), at(0.4), at(0.2)), (None, at(1), at(1))], "SatelliteIgnitionTime timestamp_ntz, SatelliteEndTime timestamp_ntz, fireout timestamp_ntz")
    rows = D.duration_gate(df.withColumn("end", D.event_end(F.col("SatelliteEndTime"), F.col("fireout")))).collect()
    assert [r.end for r in rows] == [at(1), at(0.2), at(1)]
    assert [(r.keep, r.reject_reason) for r in rows] == [(True, None), (False, "too short"), (False, "no satellite times")]


def cells(spark, rows):
    return spark.createDataFrame(rows, "case_id int, row_no int, col_no int, fuel int")


def test_nearest_fuel_by_ring_then_distance(spark):
    start = spark.createDataFrame([(1, 0, 0)], "case_id int, row0 int, col0 int")
    one = grids.nearest_valid(cells(spark, [(1, 0, 0, 90), (1, 2, 2, 101), (1, 2, 0, 101)]), start).first()
    assert (one.row_no, one.col_no, one.moved) == (2, 0, True)
    two = grids.nearest_valid(cells(spark, [(1, 0, 0, 90), (1, 3, 3, 101), (1, 4, 0, 101)]), start).first()
    assert (two.row_no, two.col_no) == (3, 3)
    none = grids.nearest_valid(cells(spark, [(1, 0, 0, 90)]), start).first()
    assert none.row_no is None


def test_later_class_overwrites_and_layers_take_the_wider(spark):
    widths = config.class_widths(spark)
    rows = [(1, "road", "motorway", 0, 50, 100, 50), (2, "road", "path", 50, 0, 50, 100), (3, "water", "river", 90, 0, 90, 100), (4, "water", "unknown", 0, 0, 9, 9)]
    lines = spark.createDataFrame(rows, "seg_id int, layer string, class string, x1 int, y1 int, x2 int, y2 int")
    got = {(r.u, r.v): r.width for r in B.barrier_raster(B.touched_cells(B.with_widths(lines, widths), 10.0)).collect()}
    assert got[5, 5] == 2.0 and got[2, 5] == 30.0 and got[9, 5] == 30.0 and (0, 0) not in got


def test_backup_rivers(spark):
    make = lambda rows: spark.createDataFrame(rows, "seg_id int, x1 double, y1 double, x2 double, y2 double")
    backup = make([(1, 0.0, 0.0, 10.0, 0.0), (2, 0.0, 3.0, 10.0, 3.0), (3, 5.0, -5.0, 5.0, 5.0)])
    assert [r.seg_id for r in B.not_near(backup, make([(9, 0.0, 0.5, 10.0, 0.5)])).collect()] == [2]
    assert B.not_near(backup, make([(9, 0.0, 0.5, 10.0, 0.5)]).limit(0)).count() == 3


def test_stack_grows_to_the_north_and_east(spark):
    small = spark.createDataFrame([(1, 1, r, c, 10 * r + c) for r in range(2) for c in range(2)], "case_id int, band int, row_no int, col_no int, value int")
    got = {(r.row_no, r.col_no): r.value for r in grids.fit_to_reference(small, 3, 3).collect()}
    assert got == {(r, c): 10 * max(r - 1, 0) + min(c, 1) for r in range(3) for c in range(3)}


def test_bilinear_of_a_plane_is_the_plane(spark):
    plane = spark.createDataFrame([(1, 1, r, c, 2.0 * r + c) for r in range(6) for c in range(6)], "case_id int, band int, row_no int, col_no int, value double")
    for r in grids.bilinear_grid(plane, (0.0, 6.0, 1.0, 6, 6), (0.0, 6.0, 0.5, 12, 12)).where("row_no between 1 and 10 and col_no between 1 and 10").collect():
        assert abs(r.value - (2 * ((r.row_no + 0.5) / 2 - 0.5) + (r.col_no + 0.5) / 2 - 0.5)) < 1e-12


def test_decimation_keeps_the_ends(spark):
    curve = spark.range(1000).selectExpr("1 as case_id", "id as t")
    got = sorted(r.t for r in R.decimated(curve, "case_id", "t", 300).collect())
    assert got == sorted({round(k * 999 / 299) for k in range(300)}) and R.decimated(curve.limit(20), "case_id", "t", 300).count() == 20


def test_histogram_closes_the_last_bin(spark):
    got = R.histogram(spark.createDataFrame([(1, float(v)) for v in (0, 1, 2, 10)], "k int, v double"), ["k"], "v", 5).orderBy("bin").collect()
    assert [r.n for r in got] == [2, 1, 0, 0, 1]


def test_lenient_times(spark):
    df = spark.createDataFrame([("2024-07-01T00", "130"), ("2024-07-01", "2561"), ("junk", "0100"), ("2024-07-01", None)], "d string, t string")
    assert [r[0] for r in df.select(X.hotspot_time(F.col("d"), F.col("t"))).collect()] == [at(0, 5400), None, None, None]
    names = spark.createDataFrame([("a_07-01-2024_0130_x.asc",), ("a.asc",)], "n string")
    assert [r[0] for r in names.select(X.time_key(F.col("n"))).collect()] == [at(0, 5400), None]


def test_projections_against_known_places(spark):
    df = spark.createDataFrame([(-96.0, 23.0, -121.3)], "lon double, lat double, west double")
    x, y = P.albers(F.col("lon"), F.col("lat"))
    assert max(map(abs, df.select(x, y).first())) < 1e-6
    e, n = P.utm(F.col("west"), F.col("lat") + 16, 10)
    lon, lat = P.utm_inverse(F.col("e"), F.col("n"), 10)
    back = df.select(e.alias("e"), n.alias("n")).select("e", "n", lon.alias("lon"), lat.alias("lat")).first()
    assert abs(back.lon + 121.3) < 1e-7 and abs(back.lat - 39) < 1e-7
    assert abs(P_easting_at_equator(spark) - 500_000) < 1e-6


def P_easting_at_equator(spark):
    return spark.range(1).select(P.utm(F.lit(-123.0), F.lit(0.0), 10)[0]).first()[0]


def test_log_states(spark):
    logs = {1: ["=== STEP 1: fetch ===", "=== STEP 2: wind ==="], 2: ["hello"], 3: ["=== STEP 3: x ===", "Traceback (most recent call last)", "ValueError: bad"], 4: ["=== STEP 9: y ===", "CASE COMPLETED."], 5: ["=== STEP 1: z ===", "Traceback (most recent call last)", *["ok"] * 70]}
    df = spark.createDataFrame([(c, i + 1, t) for c, lines in logs.items() for i, t in enumerate(lines)], "case_id int, line_no int, text string")
    got = {r.case_id: (r.status, r.step, r.error) for r in L.case_state(df).collect()}
    assert got == {1: ("running", 2, None), 2: ("starting", None, None), 3: ("failed", 3, "ValueError: bad"), 4: ("done", 12, None), 5: ("running", 1, None)}
    every = spark.createDataFrame([(k,) for k in range(1, 8)], "case_id int")
    got = {r.case_id: r.status for r in L.case_state(df, every, every.where("case_id in (2, 7)")).collect()}
    assert got == {1: "running", 2: "done", 3: "failed", 4: "done", 5: "running", 6: "pending", 7: "done"}


def test_weather_windows_and_fallback(spark):
    hours = spark.createDataFrame([(1, at(0, 3600 * h), float(h)) for h in range(10)], "case_id int, ts timestamp_ntz, wind_kph double")
    window = spark.createDataFrame([(1, at(0, 3600 * 2 + 60), at(0, 3600 * 4 + 60))], "case_id int, start_ts timestamp_ntz, end_ts timestamp_ntz")
    count = {m: W.in_window(hours, window, m).count() for m in W.MODES}
    assert count == {"sink": 4, "wxs": 3, "model": 5, "legacy": 2}
    assert W.mean_wind(hours, window).first().wind_kph == 3.5 and W.mean_wind(hours, window.limit(0)).first().wind_kph == 4.5


def test_collisions_raise(spark):
    a = spark.createDataFrame([(1, 2)], "case_id int, v int")
    with pytest.raises(Exception, match="name collision"):
        C.guarded_union([a, a], ["case_id"]).collect()
    with pytest.raises(ValueError, match="missing columns"):
        require_columns(a, "geometry")


def test_files_round_trip(spark, tmp_path):
    for case, text in (("00001", "=== STEP 1: a ===\nx = 3\n"), ("00002", "CASE COMPLETED.")):
        (tmp_path / "runs" / case).mkdir(parents=True)
        (tmp_path / "runs" / case / "pipeline.log").write_text(text)
    log = T.read_log(spark, f"{tmp_path}/runs/*/pipeline.log")
    assert sorted((r.case_id, r.line_no, r.text) for r in log.collect())[:2] == [("00001", 1, "=== STEP 1: a ==="), ("00001", 2, "x = 3")]
    assert {r.case_id: r.status for r in L.case_state(log).collect()} == {"00001": "running", "00002": "done"}
    assert sorted(r.case_id for r in C.newest(T.files_of(spark, f"{tmp_path}/runs/*/*.log")).collect()) == ["00001", "00002"]
    cases = spark.createDataFrame([("00001", 5, DAY), ("00003", 6, DAY)], "case_id string, acres int, discovery timestamp_ntz")
    T.write_metadata(cases, spark.createDataFrame([("00001",)], "case_id string"), f"{tmp_path}/meta")
    back = spark.read.text(f"{tmp_path}/meta").collect()
    assert [r.value for r in back] == ['{"acres":5,"discovery":"2024-07-01T00:00:00"}']


def test_grid_text_round_trip(spark):
    cells_ = spark.createDataFrame([(1, 0, 0, 1.5), (1, 1, 1, -3.0)], "case_id int, row_no int, col_no int, value double")
    size = spark.createDataFrame([(1, 2, 2, 10.0, 20.0, 5.0)], "case_id int, ncols int, nrows int, xll double, yll double, cellsize double")
    got = {(r.row_no, r.col_no): (r.x, r.y, r.value) for r in T.grid_cells(T.grid_text(cells_, size)).collect()}
    assert got == {(0, 0): (12.5, 27.5, 1.5), (0, 1): (17.5, 27.5, None), (1, 0): (12.5, 22.5, None), (1, 1): (17.5, 22.5, 0.0)}


def test_a_split_log_keeps_its_line_numbers(spark, tmp_path):
    (tmp_path / "00007").mkdir()
    lines = [f"line {i} " + "x" * (i % 50) for i in range(5000)]
    (tmp_path / "00007" / "pipeline.log").write_text("\r\n".join(lines))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        log = T.read_log(spark, f"{tmp_path}/*/pipeline.log")
        assert [r.text for r in log.orderBy("line_no").collect()] == lines and log.agg({"line_no": "max"}).first()[0] == 5000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_stream_goes_on_where_it_stopped(spark, tmp_path):
    from cinderframe.streaming import live

    day = lambda d, h: (1, dt.datetime(2024, 7, d, h), d, h)
    schema = "case_id int, sat_ts timestamp, x int, y int"
    spark.createDataFrame([day(1, 1), day(1, 2), day(5, 1)], schema).write.mode("append").parquet(f"{tmp_path}/in")
    run = lambda: sorted(r.n for r in live.drained(live.chains(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), "12 hours"), str(tmp_path), name="chains").collect())
    assert run() == [2]
    spark.createDataFrame([day(5, 3), day(9, 1)], schema).write.mode("append").parquet(f"{tmp_path}/in")
    assert run() == [2, 2] and run() == [2, 2]


def test_numbers_without_one_task(spark):
    from cinderframe.folders import numbered

    df = spark.range(1000).selectExpr("(id * 37) % 1000 as k", "id % 7 as v").repartition(9)
    assert sorted((r.k, r.nth) for r in numbered(df, "k").collect()) == [(k, k + 1) for k in range(1000)]


def test_sources_name_what_they_lack(spark, tmp_path):
    spark.createDataFrame([(1, "a", 7)], "perim_idx long, perim_name string, other int").write.parquet(f"{tmp_path}/p")
    with pytest.raises(ValueError, match="ig_date"):
        T.read_perimeters(spark, f"{tmp_path}/p")
    spark.createDataFrame([("2024-07-01", "930", 1)], "acq_date string, acq_time string, x int").write.json(f"{tmp_path}/h")
    rows = T.read_hotspots(spark, f"{tmp_path}/h", "json").collect()
    assert [(r.sat_ts, r.det_id, r.x, r.y) for r in rows] == [(dt.datetime(2024, 7, 1, 9, 30), None, 1.0, None)]


def square(x, y, h):
    return [[{"x": x - h, "y": y - h}, {"x": x + h, "y": y - h}, {"x": x + h, "y": y + h}, {"x": x - h, "y": y + h}]]


RINGS = "array<array<struct<x:double,y:double>>>"


def test_end_lies_within_the_first_chain(spark):
    """Detections on two days, and on three days two months later: the fire ends with its own chain."""
    cases = spark.createDataFrame([(1, square(0.0, 0.0, 900.0), at(-1), None), (2, None, at(0), None), (3, square(9e4, 0.0, 90.0), at(0), None), (4, square(0.0, 0.0, 900.0), at(99), None)], f"case_id int, rings {RINGS}, discovery timestamp_ntz, fireout timestamp_ntz")
    hits = spark.createDataFrame([(at(d), 250.0 * k, 0.0) for k, d in enumerate((0, 1, 60, 61, 62))], "sat_ts timestamp_ntz, x double, y double")
    got = {r.case_id: r for r in D.dated(cases, hits).collect()}
    assert (got[1].SatelliteIgnitionTime, got[1].SatelliteEnd_chain, got[1].SatelliteEndTime, got[1].status) == (at(0), at(1), at(1), "OK")
    assert [got[k].reason for k in (2, 3, 4)] == [D.SKIPS[0], D.SKIPS[2], D.SKIPS[3]] and got[2].status == "SKIP"


def test_report_covers_only_the_burn(spark):
    cases = spark.createDataFrame([(1, square(0.0, 0.0, 100.0), at(0), 40_000.0)], f"case_id int, rings {RINGS}, discovery timestamp_ntz, burn_area_m2 double")
    hits = spark.createDataFrame([(1, at(0), 0.0, 0.0), (1, at(1), 90.0, 0.0)], "case_id int, sat_ts timestamp_ntz, x double, y double")
    curve, ends = D.report_end(hits, cases)
    assert [r.area_m2 for r in curve.orderBy("sat_ts").collect()] == [40_000.0, 40_000.0] and ends.first().sat_end == at(0)


def test_tiles_follow_the_extent(spark):
    from cinderframe.functions.geometry import points_in_polygons

    many = [{"x": 5e4 + 3e4 * math.cos(k / 50 * math.pi), "y": 3e4 * math.sin(k / 50 * math.pi)} for k in range(100)]
    polygons = spark.createDataFrame([(1, square(0.0, 0.0, 30_000.0)), (2, square(10.0, 10.0, 20.0)), (3, [many]), (4, None)], f"perim_idx int, rings {RINGS}")
    points = spark.createDataFrame([(k, 997.0 * k - 9e4, 13.0) for k in range(200)] + [(999, 12.0, 12.0), (1000, None, 1.0)], "pt int, x double, y double")
    pairs = points_in_polygons(points, polygons, 200.0)
    want = {(1, k) for k in range(200) if abs(997.0 * k - 9e4) < 3e4} | {(1, 999), (2, 999)} | {(3, k) for k in range(200) if abs(997.0 * k - 9e4 - 5e4) < 29_950}
    assert {(r.perim_idx, r.pt) for r in pairs.collect()} == want


def test_crs_is_asked_for(spark):
    from cinderframe.operators.cases import assumed_crs

    df = spark.createDataFrame([(1, 10.0, 20.0), (2, 5e5, 20.0)], "case_id int, x double, y double")
    assert [r.epsg for r in assumed_crs(df).orderBy("case_id").collect()] == [4326, None]
    with pytest.raises(Exception, match="case 2 has no CRS"):
        assumed_crs(df, strict=True).collect()


def test_files_without_a_header_are_named(spark, tmp_path):
    from cinderframe.operators import weather as W
    from cinderframe.sources import tables as S

    good = "RAWS_UNITS: Metric\nYear Mth Day Time Temp RH HrlyPcp WindSpd WindDir CloudCov\n2024 7 1 30 20 40 0.5 10 270 50\r\n2024 7 1 130 short\n"
    for case, name, text in ((7, "a.wxs", good), (8, "b.wxs", good), (8, "notes.txt", "no weather")):
        (tmp_path / f"{case:05d}").mkdir(exist_ok=True)
        (tmp_path / f"{case:05d}" / name).write_text(text)
    got = W.from_text(S.file_lines(spark, str(tmp_path), "*.wxs", S.WEATHER_FILE)).orderBy("case_id").collect()
    assert [(r.case_id, r.ts.minute, r.wind_kph) for r in got] == [(7, 30, 10.0), (8, 30, 10.0)]
    (tmp_path / "00007" / "a.wxs").write_text(good.replace("WindSpd", "Wind"))
    with pytest.raises(Exception, match="no header or no rows in .*00007/a.wxs"):
        W.from_text(S.file_lines(spark, str(tmp_path), "*.wxs", S.WEATHER_FILE)).collect()
