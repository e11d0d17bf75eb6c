"""Queries on rasters and barriers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..operators import barriers as B
from ..operators import grids as G
from .fixtures import frame
from .registry import query


def bands(spark: SparkSession, sf: str) -> DataFrame:
    return frame(spark, sf, "bands")


def round6(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


NAMES = ", ".join(f"({k}, '{v}')" for k, v in config.BAND_LAYERS.items())


@query("s13_split_bands", "bands", f"select b.case_id, l.layer, b.row_no, b.col_no, b.value from bands b join (values {NAMES}) l(band, layer) on l.band = b.band")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return G.split_bands(bands(spark, sf), config.band_layers(spark)).select("case_id", "layer", "row_no", "col_no", "value")


@query("s13_missing_bands", "bands", f"select c.case_id, l.band, l.layer from (select distinct case_id from bands) c cross join (values {NAMES}) l(band, layer) where (c.case_id, l.band) not in (select case_id, band from bands)")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return G.missing_bands(bands(spark, sf), config.band_layers(spark))


@query("p31_constant_layers", "bands", "select case_id, row_no, col_no, l as layer, 1.0::double as value from bands, (values ('adj'), ('phi')) t(l) where band = 1")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return G.constant_layers(bands(spark, sf).where("band = 1"))


@query("p27_cell_and_centre", "perimeters", "select perim_idx, cast(floor((2500 - cy) / 30.0) as bigint) as row_no, cast(floor((cx + 100) / 30.0) as bigint) as col_no, -100 + (floor((cx + 100) / 30.0) + .5) * 30 as x, 2500 - (floor((2500 - cy) / 30.0) + .5) * 30 as y from perimeters")
def _(spark: SparkSession, sf: str) -> DataFrame:
    row, col = G.cell_of(F.col("cx"), F.col("cy"), -100.0, 2500.0, 30.0)
    at = frame(spark, sf, "perimeters").select("perim_idx", row.alias("row_no"), col.alias("col_no"))
    x, y = G.centre_of(F.col("row_no"), F.col("col_no"), -100.0, 2500.0, 30.0)
    return at.withColumns({"x": x, "y": y})


@query("p29_valid_fuel", "cells", "select case_id, row_no, col_no, nullif(fuel, 95) >= 101 as valid from cells")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return frame(spark, sf, "cells").select("case_id", "row_no", "col_no", (G.to_null(F.col("fuel"), 95) >= config.FIRST_FUEL).alias("valid"))


@query("a1_zonal_means", "cells", "select case_id, fuel, count(*) as n, round(avg(m1), 6) as mean_m1, round(avg(m10), 6) as mean_m10, round(avg(m100), 6) as mean_m100 from cells group by case_id, fuel")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return round6(G.zonal_means(frame(spark, sf, "cells")), "mean_m1", "mean_m10", "mean_m100")


@query("p38_moisture_lines", "cells", """
with lines as (select case_id, cast(fuel as bigint) as fuel, cast(round_even(avg(m1), 0) as bigint) as m1, cast(round_even(avg(m10), 0) as bigint) as m10, cast(round_even(avg(m100), 0) as bigint) as m100, 60 as live_herb, 90 as live_wood from cells group by case_id, fuel)
select * from lines union all select case_id, 0, m1, m10, m100, live_herb, live_wood from lines qualify row_number() over (partition by case_id order by fuel) = 1
""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return G.moisture_lines(G.zonal_means(frame(spark, sf, "cells")))


@query("j15_aligned_layers", "cells", """
select case_id, row_no, col_no, cast(fuel as double) as fuel, cast(m1 as double) as m1, cast(m10 as double) as m10, cast(m100 as double) as m100 from cells
where fuel % 5 > 0 and m1 is not null and (row_no + col_no) % 7 > 0 and m100 is not null
""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Four layers in one long table, with cells of no data and cells that a layer lacks."""
    wide = frame(spark, sf, "cells").withColumn("fuel", F.when(F.col("fuel") % 5 > 0, F.col("fuel")).otherwise(config.NODATA))
    long = wide.select("case_id", "row_no", "col_no", *[F.col(c).cast("double").alias(c) for c in LAYERS]).unpivot(["case_id", "row_no", "col_no"], list(LAYERS), "layer", "value")
    return G.aligned_layers(long.where((F.col("layer") != "m10") | ((F.col("row_no") + F.col("col_no")) % 7 > 0)), LAYERS)


LAYERS = ("fuel", "m1", "m10", "m100")


@query("j11_nearest_fuel", "cells", """
with starts as (select case_id, least(greatest(case_id * 5, min(row_no)), max(row_no)) as row0, least(greatest(case_id * 3, min(col_no)), max(col_no)) as col0 from cells group by case_id)
select case_id, row_no, col_no, ring > 0 as moved from (
  select c.case_id, row_no, col_no, greatest(abs(row_no - row0), abs(col_no - col0)) as ring, (row_no - row0) * (row_no - row0) + (col_no - col0) * (col_no - col0) as d2
  from cells c join starts s on s.case_id = c.case_id where fuel >= 101) t qualify row_number() over (partition by case_id order by ring, d2, row_no, col_no) = 1
""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    cells = frame(spark, sf, "cells")
    starts = cells.select("case_id").distinct().select("case_id", (F.col("case_id") * 5).alias("row0"), (F.col("case_id") * 3).alias("col0"))
    return G.nearest_valid(cells, starts)


#: The bands' grid, and two others of other origins and cell widths.
SOURCE, COARSE, FINE = (500.0, 1300.0, 30.0, 10, 10), (470.0, 1325.0, 70.0, 5, 6), (512.5, 1290.0, 12.5, 20, 22)


@query("j12_nearest_grid", "bands", """
select w.case_id, w.band, w.row_no, w.col_no, b.value from (select distinct case_id, band, r as row_no, c as col_no from bands, generate_series(0, 4) x(r), generate_series(0, 5) y(c)) w
left join bands b on b.case_id = w.case_id and b.band = w.band and b.row_no = floor((1300 - (1325 - (w.row_no + .5) * 70)) / 30) and b.col_no = floor((470 + (w.col_no + .5) * 70 - 500) / 30)
""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return G.nearest_grid(bands(spark, sf), SOURCE, COARSE)


@query("j13_bilinear_grid", "bands", """
select case_id, band, row_no, col_no, round(sum(w * value) / sum(w), 6) as value from (
  select t.case_id, t.band, t.row_no, t.col_no, b.value, (1 - abs(fr - b.row_no)) * (1 - abs(fc - b.col_no)) as w
  from (select distinct case_id, band, r as row_no, c as col_no, (1300 - (1290 - (r + .5) * 12.5)) / 30 - 0.5 as fr, (512.5 + (c + .5) * 12.5 - 500) / 30 - 0.5 as fc from bands, generate_series(0, 19) x(r), generate_series(0, 21) y(c)) t
  join bands b on b.case_id = t.case_id and b.band = t.band and abs(fr - b.row_no) < 1 and abs(fc - b.col_no) < 1) q group by all
""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return round6(G.bilinear_grid(bands(spark, sf), SOURCE, FINE), "value")


@query("j13_coarse_wind", "bands", """
select case_id, band, row_no, col_no, round(sum(w * value) / sum(w), 6) as value from (
  select t.case_id, t.band, t.row_no, t.col_no, b.value, (1 - abs(fr - b.row_no)) * (1 - abs(fc - b.col_no)) as w
  from (select distinct case_id, band, r as row_no, c as col_no, (r + .5) * 4 - 0.5 as fr, (c + .5) * 4 - 0.5 as fc from bands, generate_series(0, 2) x(r), generate_series(0, 2) y(c)) t
  join bands b on b.case_id = t.case_id and b.band = t.band and abs(fr - b.row_no) < 1 and abs(fc - b.col_no) < 1) q group by all
""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Cells four times as wide as the source's."""
    return round6(G.bilinear_grid(bands(spark, sf), SOURCE, G.coarsened(SOURCE)), "value")


SIZED = "with sized as (select *, max(row_no) over (partition by case_id, band) + 1 as nr, max(col_no) over (partition by case_id, band) + 1 as nc from bands) "


@query("w11_fit_to_reference", "bands", SIZED + """
select w.case_id, w.band, w.row_no, w.col_no, b.value from (select distinct case_id, band, nr, nc, r as row_no, c as col_no from sized, generate_series(0, 11) x(r), generate_series(0, 8) y(c)) w
left join bands b on b.case_id = w.case_id and b.band = w.band and b.row_no = greatest(w.row_no - (12 - nr), 0) and b.col_no = least(w.col_no, nc - 1)
""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return G.fit_to_reference(bands(spark, sf), 12, 9)


HOLES = "with holed as (select case_id, band, row_no, col_no, case when row_no < 2 or col_no > 7 or (row_no + col_no + band) % 9 = 0 then null else value end as value from bands) "


def holed(spark: SparkSession, sf: str) -> DataFrame:
    gone = (F.col("row_no") < 2) | (F.col("col_no") > 7) | ((F.col("row_no") + F.col("col_no") + F.col("band")) % 9 == 0)
    return bands(spark, sf).withColumn("value", F.when(~gone, F.col("value")))


@query("a16_empty_lines", "bands", HOLES + "select case_id, 'row' as axis, row_no as line from holed group by case_id, row_no having bool_and(value is null) union all select case_id, 'col', col_no from holed group by case_id, col_no having bool_and(value is null)")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return G.empty_lines(holed(spark, sf))


@query("w12_filled_edges", "bands", HOLES + """
, ends as (select case_id, min(row_no) as fr, max(col_no) as lc from holed where value is not null group by case_id)
select h.case_id, h.band, h.row_no, h.col_no, s.value from holed h join ends o on o.case_id = h.case_id
left join holed s on s.case_id = h.case_id and s.band = h.band and s.row_no = greatest(h.row_no, o.fr) and s.col_no = least(h.col_no, o.lc)
""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return G.fill_edges(holed(spark, sf))


@query("a13_band_counts", "bands weather_hourly", """
with ws as (select case_id, count(distinct band) as ws from bands where case_id % 4 > 0 group by case_id), m1 as (select case_id, count(distinct band) as m1 from bands where case_id % 3 > 0 or band > 2 group by case_id),
rows_ as (select case_id, greatest(0, count(*) - 480) as fire_rows from weather_hourly group by case_id)
select case_id, ws, m1, fire_rows, case when ws = m1 then 'OK' when ws <> m1 then 'MISMATCH (diff=' || case when m1 > ws then '+' else '' end || (m1 - ws) || ')' end as status
from ws full join m1 using (case_id) full join rows_ using (case_id)
""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Wind stacks that some cases lack against moisture stacks that are short in others."""
    stack = bands(spark, sf)
    return G.band_counts(stack.where("case_id % 4 > 0"), stack.where("case_id % 3 > 0 or band > 2"), frame(spark, sf, "weather_hourly"))


@query("w10_band_numbers", "weather_hourly", "select case_id, ts, dense_rank() over (partition by case_id order by ts) as band from weather_hourly")
def _(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.sql import Window

    return frame(spark, sf, "weather_hourly").select("case_id", "ts", F.dense_rank().over(Window.partitionBy("case_id").orderBy("ts")).alias("band"))


WIDTHS = ", ".join(f"('{a}', '{b}', {w}, {i})" for i, (a, b, w) in enumerate(config.CLASS_WIDTHS))
DIST = "case when (x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1) = 0 then 0.0 else greatest(0.0, least(1.0, (({x} - x1) * (x2 - x1) + ({y} - y1) * (y2 - y1)) / (1.0 * (x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)))) end"


@query("p20_class_width", "barrier_segments", f"select s.seg_id, w.width from barrier_segments s join (values {WIDTHS}) w(layer, class, width, r) on w.layer = s.layer and w.class = s.class")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return B.with_widths(frame(spark, sf, "barrier_segments"), config.class_widths(spark)).select("seg_id", "width")


@query("j7_clip_to_extent", "barrier_segments", "select seg_id, k as case_id from barrier_segments, generate_series(0, 4) c(k) where class is not null and greatest(x1, x2) >= k * 60 and least(x1, x2) <= k * 60 + 100 and greatest(y1, y2) >= k * 50 and least(y1, y2) <= k * 50 + 100")
def _(spark: SparkSession, sf: str) -> DataFrame:
    cases = spark.range(5).select(F.col("id").alias("case_id"), (F.col("id") * 60).alias("xmin"), (F.col("id") * 60 + 100).alias("xmax"), (F.col("id") * 50).alias("ymin"), (F.col("id") * 50 + 100).alias("ymax"))
    return B.clip(frame(spark, sf, "barrier_segments"), cases).select("seg_id", "case_id")


def _apart2(p: str, s: str) -> str:
    """SQL: squared distance of a point to a segment; aliases of (x, y) columns and of (x1, y1, x2, y2) columns."""
    x, y = p
    a = f"(({x} - {s}.x1) * ({s}.x2 - {s}.x1) + ({y} - {s}.y1) * ({s}.y2 - {s}.y1))"
    d2 = f"(1.0 * ({s}.x2 - {s}.x1) * ({s}.x2 - {s}.x1) + ({s}.y2 - {s}.y1) * ({s}.y2 - {s}.y1))"
    t = f"(case when {d2} = 0 then 0.0 else greatest(0.0, least(1.0, {a} / {d2})) end)"
    return f"(({x} - {s}.x1 - {t} * ({s}.x2 - {s}.x1)) ** 2 + ({y} - {s}.y1 - {t} * ({s}.y2 - {s}.y1)) ** 2)"


def _side(s: str, x: str, y: str) -> str:
    return f"(({s}.x2 - {s}.x1) * ({y} - {s}.y1) - ({s}.y2 - {s}.y1) * ({x} - {s}.x1))"


NEAR = " or ".join(f"{_apart2((f'{p}.x{i}', f'{p}.y{i}'), s)} <= 4" for p, s in (("a", "b"), ("b", "a")) for i in (1, 2))
CROSS = f"({_side('a', 'b.x1', 'b.y1')} * {_side('a', 'b.x2', 'b.y2')} < 0 and {_side('b', 'a.x1', 'a.y1')} * {_side('b', 'a.x2', 'a.y2')} < 0)"


SPREAD = "with spread as (select seg_id, class, x1 + 450 * (seg_id % 19) as x1, y1, x2 + 450 * (seg_id % 19) as x2, y2 from barrier_segments) "


@query("j6_backup_rivers", "barrier_segments", SPREAD + f"select seg_id from spread a where class = 'unknown' and not exists (select 1 from spread b where b.class = 'river' and ({CROSS} or {NEAR}))")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """The lines side by side in 19 panels, so that some are far from every river."""
    aside = 450 * (F.col("seg_id") % 19)
    lines = frame(spark, sf, "barrier_segments").withColumns({"x1": F.col("x1") + aside, "x2": F.col("x2") + aside})
    return B.not_near(lines.where("class = 'unknown'"), lines.where("class = 'river'"), tolerance=2.0).select("seg_id")


@query("j19_touched_cells")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return B.touched_cells(B.with_widths(frame(spark, sf, "barrier_segments"), config.class_widths(spark)), cell=10.0).select("seg_id", "u", "v")


@query("a15_barrier_raster")
def _(spark: SparkSession, sf: str) -> DataFrame:
    touched = B.touched_cells(B.drawn_once(B.with_widths(frame(spark, sf, "barrier_segments"), config.class_widths(spark))), cell=10.0)
    return B.barrier_raster(touched)


TOUCHED = f"""
with w as (select s.*, t.width, t.r from barrier_segments s join (values {WIDTHS}) t(layer, class, width, r) on t.layer = s.layer and t.class = s.class),
near as (select *, unnest(generate_series(cast(floor((least(y1, y2) - width / 2) / 20.0) as bigint), cast(floor((greatest(y1, y2) + width / 2) / 20.0) as bigint))) as v
  from (select *, unnest(generate_series(cast(floor((least(x1, x2) - width / 2) / 20.0) as bigint), cast(floor((greatest(x1, x2) + width / 2) / 20.0) as bigint))) as u from w) q),
hit as (select u, v, layer, width, r from (select *, {DIST.format(x="(u + .5) * 20", y="(v + .5) * 20")} as t from near) q
  where ((u + .5) * 20 - (x1 + t * (x2 - x1))) * ((u + .5) * 20 - (x1 + t * (x2 - x1))) + ((v + .5) * 20 - (y1 + t * (y2 - y1))) * ((v + .5) * 20 - (y1 + t * (y2 - y1))) <= width * width / 4)
"""


@query("a14_cells_by_class", "barrier_segments", TOUCHED.replace("hit as (select u, v, layer, width, r", "hit as (select u, v, layer, class, width, r") + "select layer, class, count(distinct (u, v)) as cells from hit group by layer, class")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Area of each class's buffered lines as cells, overlaps counted once."""
    touched = B.touched_cells(B.drawn_once(B.with_widths(frame(spark, sf, "barrier_segments"), config.class_widths(spark))), cell=20.0, by_centre=True)
    return touched.select("layer", "class", "u", "v").distinct().groupBy("layer", "class").agg(F.count("*").alias("cells"))


@query("a15_barrier_on_grid", "barrier_segments", TOUCHED + """
select g.u, g.v, coalesce(max(b.width), 0.0) as width from (select u, v from generate_series(0, 21) a(u), generate_series(0, 21) b(v)) g
left join (select u, v, layer, max_by(width, r) as width from hit group by all) b on b.u = g.u and b.v = g.v group by g.u, g.v
""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    touched = B.touched_cells(B.drawn_once(B.with_widths(frame(spark, sf, "barrier_segments"), config.class_widths(spark))), cell=20.0, by_centre=True)
    grid = spark.range(22).select(F.col("id").alias("u"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(21).cast("long"))).alias("v"))
    return B.on_grid(B.barrier_raster(touched), grid)


@query("u3_barrier_layers", "barrier_segments", "select layer, class, count(*) as n, count(width) as with_width from (select layer, class, null as width from barrier_segments where layer = 'road' union all select layer, class, 5.0 from barrier_segments where layer = 'water') t group by layer, class")
def _(spark: SparkSession, sf: str) -> DataFrame:
    lines = frame(spark, sf, "barrier_segments").select("layer", "class")
    both = lines.where("layer = 'road'").unionByName(lines.where("layer = 'water'").withColumn("width", F.lit(config.BACKUP_WIDTH_M)), allowMissingColumns=True)
    return both.groupBy("layer", "class").agg(F.count("*").alias("n"), F.count("width").alias("with_width"))
