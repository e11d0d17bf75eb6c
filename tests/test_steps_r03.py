"""Small cases of steps that grew faster than their tables."""

import datetime as dt
import inspect

from cinderframe.functions import geometry as G
from cinderframe.operators import barriers as B
from cinderframe.operators import dating as D
from cinderframe.operators import dissolve, grids
from cinderframe.operators import matching as M

RINGS = "array<array<struct<x:double,y:double>>>"
DAY = dt.datetime(2020, 6, 1)


def diamond(x, y, h):
    return [[{"x": x + h, "y": y}, {"x": x, "y": y + h}, {"x": x - h, "y": y}, {"x": x, "y": y - h}]]


def plan(df):
    return df._jdf.queryExecution().toString()


def test_copies_of_places_and_shapes_are_tested_once(spark, monkeypatch):
    tested = []
    near_points = G.near_points

    def seen(*args, **kwargs):
        tested.append(near_points(*args, **kwargs).count())
        return near_points(*args, **kwargs)

    monkeypatch.setattr(G, "near_points", seen)
    points = spark.range(600).selectExpr("id as pt", "cast(id % 3 as double) * 40 as x", "0.0 as y")
    polygons = spark.createDataFrame([(k, diamond(0.0, 0.0, 50.0 + 40 * (k % 2))) for k in range(40)], f"perim_idx int, rings {RINGS}")
    got = {(r.perim_idx, r.pt) for r in G.points_in_polygons(points, polygons, 200.0).collect()}
    assert got == {(k, i) for k in range(40) for i in range(600) if i % 3 * 40 < 50 + 40 * (k % 2)}
    assert tested == [5]  # three places and two shapes: the bounds of one hold only two


def test_nearest_in_time_is_the_best_of_all_pairs(spark):
    points = [(k, DAY + dt.timedelta(hours=37 * k % 4001), float(k * 31 % 200), float(k * 17 % 200)) for k in range(120)]
    points += [(900, DAY, 10.0, 10.0), (901, DAY, 10.0, 10.0), (902, None, 10.0, 10.0), (903, DAY + dt.timedelta(days=4000), 5000.0, 5000.0)]
    areas = [(k, DAY + dt.timedelta(days=7 * k), diamond(k * 13.0 % 200, 60.0, 20.0 + k)) for k in range(40)]
    areas += [(100, DAY, diamond(10.0, 10.0, 5.0)), (101, DAY, diamond(5000.0, 5000.0, 5.0)), (102, DAY, diamond(-900.0, 0.0, 5.0)), (103, None, diamond(10.0, 10.0, 5.0)), (104, DAY, None)]
    a = spark.createDataFrame(points, "pt_idx int, discovery timestamp_ntz, x double, y double")
    p = spark.createDataFrame(areas, f"perim_idx int, ig_date timestamp_ntz, rings {RINGS}")
    of = lambda df: sorted((r.perim_idx, r.pt_idx, r.gap_s) for r in df.collect())
    got = of(M.nearest_in_time(a, p))
    assert got == of(M.best_point(M.spatial_join(a, p))) and (100, 900, 0) in got and (101, 903, 4000 * 86400) in got
    assert M.nearest_in_time(a.limit(0), p).count() == 0 == M.nearest_in_time(a, p.limit(0)).count()


def test_clipping_broadcasts_no_cells(spark):
    burns = spark.createDataFrame([(1, diamond(0.0, 0.0, 300.0)), (1, diamond(100.0, 0.0, 300.0)), (2, None)], f"case_id int, rings {RINGS}")
    hits = spark.createDataFrame([(1, DAY, 250.0, 10.0), (1, DAY + dt.timedelta(hours=1), -280.0, 0.0), (2, DAY, 0.0, 0.0)], "case_id int, sat_ts timestamp_ntz, x double, y double")
    curve = D.coverage_curve(hits, burns=burns)
    assert "BroadcastHashJoin" not in curve._jdf.queryExecution().executedPlan().toString()
    cells = lambda x, y: {(u, v) for u in range(-30, 30) for v in range(-30, 30) if ((u + 0.5) * 50 - x) ** 2 + ((v + 0.5) * 50 - y) ** 2 <= 40_000}
    burn = {(u, v) for u in range(-30, 30) for v in range(-30, 30) if any(abs((u + 0.5) * 50 - x) + abs((v + 0.5) * 50) < 300 for x in (0, 100))}
    first, second = cells(250, 10) & burn, cells(-280, 0) & burn
    assert [r.area_m2 for r in curve.where("case_id = 1").orderBy("sat_ts").collect()] == [2500 * len(first), 2500 * len(first | second)]
    assert [r.area_m2 for r in curve.where("case_id = 2").collect()] == [0]


def test_runs_of_small_and_large_rings(spark):
    many = [{"x": k * 1.0, "y": 0.0} for k in range(50)] + [{"x": 49.0 - k, "y": 10.0} for k in range(50)]
    df = spark.createDataFrame([(1, [many]), (1, [many]), (2, diamond(0.0, 0.0, 3.0)), (3, []), (4, None)], f"k int, rings {RINGS}")
    got = {(r.k, r.v): (r.first, r.last) for r in G.polygon_spans(df, 1.0, "k").collect()}
    assert got == {(1, v): (0, 48) for v in range(10)} | {(2, v): (-w, w - 1) for v, w in {-3: 0, -2: 1, -1: 2, 0: 2, 1: 1, 2: 0}.items() if w}
    assert "explode(sequence(first" not in plan(grids.dissolved(df.withColumnRenamed("k", "case_id"), 1.0))
    assert {r.case_id: r.area for r in grids.dissolved(df.withColumnRenamed("k", "case_id"), 1.0).collect()} == {1: 490, 2: 12, 3: None, 4: None}


def test_edges_of_small_groups_lie_on_one_tile(spark):
    edges = spark.createDataFrame([(1, 1, k, 0.0, 0.0, 10.0 * k, 5.0) for k in range(1, 20)] + [(2, 1, k, 0.0, 0.0, 10.0 * k, 5.0) for k in range(1, 100)], "case_id int, part int, edge int, x1 double, y1 double, x2 double, y2 double")
    n = {r.case_id: r["count"] for r in dissolve._with_tiles(edges, "case_id").groupBy("case_id").count().collect()}
    assert n[1] == 19 and n[2] > 99


def test_equal_lines_are_drawn_once(spark):
    lines = spark.createDataFrame([(k, "road", "track", 0.0, 5.0, 30.0, 5.0, 4.0, 1) for k in range(50)], "seg_id int, layer string, class string, x1 double, y1 double, x2 double, y2 double, width double, class_rank int")
    assert B.drawn_once(lines).count() == 1
    assert B.touched_cells(lines, 10.0).count() == 50 * B.touched_cells(lines.limit(1), 10.0).count()
    apart = lines.withColumns({"y1": lines.y1 + 40.0, "y2": lines.y2 + 40.0})
    assert B.not_near(lines, apart, 2.0).count() == 50 and B.not_near(lines, lines, 2.0).count() == 0


def test_least_score_asks_every_held_out_document():
    from cinderframe.llm import language_id

    assert "rows" not in inspect.signature(language_id.least_score).parameters and not hasattr(language_id, "CALIBRATION")


def test_logs_of_a_folder(spark, tmp_path):
    from cinderframe.sources import tables

    for k in ("00001", "00002"):
        (tmp_path / f"case_id={k}").mkdir()
        (tmp_path / f"case_id={k}" / "part.txt").write_text(f"a{k}\nb\n")
        (tmp_path / f"case_id={k}" / "other.log").write_text("no\n")
    got = sorted((r.case_id, r.line_no, r.text) for r in tables.read_log(spark, str(tmp_path)).collect())
    assert got == [(f"case_id={k}", n, t) for k in ("00001", "00002") for n, t in ((1, f"a{k}"), (2, "b"))]
