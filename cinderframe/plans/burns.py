"""Queries on perimeters and ignitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..folders import let_go, once
from ..functions import geometry as G
from ..functions import text as X
from ..functions.projections import albers, utm, utm_epsg, utm_inverse
from ..operators import matching as M
from ..sources import tables as S
from .fixtures import frame, fresh
from .registry import query

POLYGONS = "perim_idx, perim_name, ig_date, acres"


def perimeters(spark: SparkSession, sf: str) -> DataFrame:
    """The fixture with its diamonds as rings."""
    corner = lambda dx, dy: F.struct((F.col("cx") + dx * F.col("h")).alias("x"), (F.col("cy") + dy * F.col("h")).alias("y"))
    return frame(spark, sf, "perimeters").withColumn("rings", F.array(F.array(corner(1, 0), corner(0, 1), corner(-1, 0), corner(0, -1))))


def pairs(spark: SparkSession, sf: str) -> DataFrame:
    return M.date_band_join(M.large_perimeters(perimeters(spark, sf)), frame(spark, sf, "ignitions"))


def kept(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    large, points = M.large_perimeters(perimeters(spark, sf)), frame(spark, sf, "ignitions")
    return M.survivors_of(M.verified(M.date_band_join(large, points)), large.columns, points.columns)


def cases(spark: SparkSession, sf: str) -> DataFrame:
    large, points = kept(spark, sf)
    numbered = M.number_cases(M.nearest_in_time(points, large))
    let_go(spark)  # the cases' steps are stored, and what led to them is several times the tables
    return numbered


KEY = "nullif(regexp_replace(upper({}), '[^A-Z0-9]', '', 'g'), 'UNNAMED')"
PAIRS = f"""
with pairs as (
  select * from (select *, {KEY.format("perim_name")} as k from perimeters where acres > 5000) p
  join (select *, {KEY.format("point_name")} as k from ignitions where fireout is not null) i on p.k = i.k
  where abs(floor(date_sub('second', ig_date, discovery) / 86400.0)) <= 2
), verified as (select * from pairs where abs(x - cx) + abs(y - cy) < h
), joined as (
  select p.perim_idx, p.perim_name, p.ig_date, p.acres, p.cx, p.cy, p.h, i.pt_idx, i.point_name, i.discovery, i.fireout, i.x, i.y
  from perimeters p join ignitions i on abs(i.x - p.cx) + abs(i.y - p.cy) < p.h
  where p.perim_idx in (select perim_idx from verified) and i.pt_idx in (select pt_idx from verified)
), best as (
  select *, abs(date_sub('second', ig_date, discovery)) as gap_s from joined
  qualify row_number() over (partition by perim_idx order by abs(date_sub('second', ig_date, discovery)), pt_idx) = 1
), cases as (select *, row_number() over (order by perim_idx) as case_no from best)
"""
FIRES = "perimeters ignitions"


@query("p1_area_filter", "perimeters", "select perim_idx, round(acres, 6) as acres from perimeters where acres > 5000")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return M.large_perimeters(frame(spark, sf, "perimeters")).select("perim_idx", F.round("acres", 6).alias("acres"))


@query("p2_year_range", "perimeters", "select perim_idx, ig_date from perimeters where year(ig_date) between 1995 and 1997")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return M.in_years(frame(spark, sf, "perimeters"), "ig_date", 1995, 1997).select("perim_idx", "ig_date")


@query("p3_name_key", "ignitions", f"select pt_idx, {KEY.format('point_name')} as name_key from ignitions")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return M.with_name_key(frame(spark, sf, "ignitions"), "point_name").select("pt_idx", "name_key")


@query("p4_complete_points", "ignitions", f"select pt_idx from ignitions where {KEY.format('point_name')} is not null and discovery is not null and fireout is not null")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return M.with_name_key(frame(spark, sf, "ignitions"), "point_name").dropna(subset=["name_key", "discovery", "fireout"]).select("pt_idx")


@query(
    "p5_lenient_dates",
    sql="select o_orderkey, try_cast(case when o_orderkey % 7 = 0 then 'unknown' else strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') end as timestamp) as parsed from orders",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    text = F.when(F.col("o_orderkey") % 7 == 0, F.lit("unknown")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    return spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", X.lenient_timestamp(text).alias("parsed"))


@query("p9_case_ids", sql="select c_custkey, case when length(cast(c_custkey * 37 as varchar)) < 5 then lpad(cast(c_custkey * 37 as varchar), 5, '0') else cast(c_custkey * 37 as varchar) end as case_id from customer")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey", X.case_id(F.col("c_custkey") * 37).alias("case_id"))


@query("p10_iso_times", "ignitions", "select pt_idx, strftime(discovery, '%Y-%m-%dT%H:%M:%S') as discovery, strftime(fireout, '%Y-%m-%dT%H:%M:%S') as fireout from ignitions")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return frame(spark, sf, "ignitions").select("pt_idx", X.iso(F.col("discovery")).alias("discovery"), X.iso(F.col("fireout")).alias("fireout"))


@query("p17_grown_bounds", "perimeters", "select perim_idx, cx - h - 1.5 * h as xmin, cy - h - 1.5 * h as ymin, cx + h + 1.5 * h as xmax, cy + h + 1.5 * h as ymax from perimeters")
def _(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators.grids import grown_bounds

    return grown_bounds(G.with_bounds(perimeters(spark, sf))).select("perim_idx", "xmin", "ymin", "xmax", "ymax")


@query("p18_utm_zone", sql="select c_custkey, case when c_acctbal >= 0 then 32600 else 32700 end + cast(floor(((c_custkey * 7) % 360 - 180 + 180) / 6.0) as bigint) + 1 as epsg from customer")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey", utm_epsg((F.col("c_custkey") * 7) % 360 - 180, F.col("c_acctbal")).alias("epsg"))


@query(
    "p19_osm_width",
    sql="select p_partkey, try_cast(trim(replace(lower(regexp_split_to_array(case when p_size % 3 = 0 then p_size || ' m;4' when p_size % 3 = 1 then p_size || '.5' else 'narrow' end, '[;,/]')[1]), 'm', '')) as double) as width from part",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    size = F.col("p_size").cast("string")
    tag = F.when(F.col("p_size") % 3 == 0, F.concat(size, F.lit(" m;4"))).when(F.col("p_size") % 3 == 1, F.concat(size, F.lit(".5"))).otherwise("narrow")
    return spark.read.parquet(f"{sf}/part.parquet").select("p_partkey", X.osm_width(tag).alias("width"))


@query(
    "p25_display_name", "perimeters ignitions",
    "select p.perim_idx, coalesce(nullif(case when p.perim_idx % 3 = 0 then '' else p.perim_name end, ''), nullif(i.point_name, '')) as name, year(p.ig_date) as year from perimeters p left join ignitions i on i.pt_idx = p.perim_idx * 10 + 1",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators.cases import display_name

    left = frame(spark, sf, "perimeters").withColumn("perim_name", F.when(F.col("perim_idx") % 3 == 0, "").otherwise(F.col("perim_name"))).withColumn("pt_idx", F.col("perim_idx") * 10 + 1)
    return left.join(frame(spark, sf, "ignitions").select("pt_idx", "point_name"), "pt_idx", "left").select("perim_idx", display_name(F.col("perim_name"), F.col("point_name")).alias("name"), F.year("ig_date").cast("long").alias("year"))


@query(
    "p28_albers", sql="""
select c_custkey, round(rho0n * 0 + rho * sin(theta), 3) as x, round(rho0 - rho * cos(theta), 3) as y from (
  select c_custkey, n * (radians(lon) + radians(96.0)) as theta, a * sqrt(c - n * q) / n as rho, a * sqrt(c - n * q0) / n as rho0, 0.0 as rho0n from (
    select *, (m1 * m1 - m2 * m2) / (q2 - q1) as n, m1 * m1 + (m1 * m1 - m2 * m2) / (q2 - q1) * q1 as c from (
      select *, cos(p1) / sqrt(1 - e2 * sin(p1) * sin(p1)) as m1, cos(p2) / sqrt(1 - e2 * sin(p2) * sin(p2)) as m2,
        (1 - e2) * (sin(p0) / (1 - e2 * sin(p0) * sin(p0)) - ln((1 - sqrt(e2) * sin(p0)) / (1 + sqrt(e2) * sin(p0))) / (2 * sqrt(e2))) as q0,
        (1 - e2) * (sin(p1) / (1 - e2 * sin(p1) * sin(p1)) - ln((1 - sqrt(e2) * sin(p1)) / (1 + sqrt(e2) * sin(p1))) / (2 * sqrt(e2))) as q1,
        (1 - e2) * (sin(p2) / (1 - e2 * sin(p2) * sin(p2)) - ln((1 - sqrt(e2) * sin(p2)) / (1 + sqrt(e2) * sin(p2))) / (2 * sqrt(e2))) as q2,
        (1 - e2) * (sin(p) / (1 - e2 * sin(p) * sin(p)) - ln((1 - sqrt(e2) * sin(p)) / (1 + sqrt(e2) * sin(p))) / (2 * sqrt(e2))) as q
      from (select c_custkey, -125.0 + (c_custkey * 7) % 58 as lon, radians(24.0 + (c_custkey * 3) % 25) as p, radians(23.0) as p0, radians(29.5) as p1, radians(45.5) as p2,
            6378137.0 as a, 0.0066943800229 as e2 from customer)))) t
""")  # fmt: skip
def _(spark: SparkSession, sf: str) -> DataFrame:
    x, y = albers(-125.0 + (F.col("c_custkey") * 7) % 58, 24.0 + (F.col("c_custkey") * 3) % 25)
    return spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))


@query("j1_date_band_join", FIRES, PAIRS + "select perim_idx, pt_idx, ig_date, discovery from pairs")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return pairs(spark, sf).select("perim_idx", "pt_idx", "ig_date", "discovery")


@query("j2_within_pairs", FIRES, PAIRS + "select perim_idx, pt_idx from verified")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return M.verified(pairs(spark, sf)).select("perim_idx", "pt_idx")


@query("j3_survivors", FIRES, PAIRS + "select 'perimeter' as kind, perim_idx as id from (select distinct perim_idx from verified) union all select 'point', pt_idx from (select distinct pt_idx from verified)")
def _(spark: SparkSession, sf: str) -> DataFrame:
    a, b = kept(spark, sf)
    return a.select(F.lit("perimeter").alias("kind"), F.col("perim_idx").alias("id")).unionByName(b.select(F.lit("point").alias("kind"), F.col("pt_idx").alias("id")))


@query("j4_spatial_join", FIRES, PAIRS + "select perim_idx, pt_idx from joined")
def _(spark: SparkSession, sf: str) -> DataFrame:
    large, points = kept(spark, sf)
    return M.spatial_join(points, large).select("perim_idx", "pt_idx")


@query("w1_best_point", FIRES, PAIRS + "select perim_idx, pt_idx, gap_s from best")
def _(spark: SparkSession, sf: str) -> DataFrame:
    large, points = kept(spark, sf)
    return M.nearest_in_time(points, large).select("perim_idx", "pt_idx", "gap_s")


@query("w2_case_numbers", FIRES, PAIRS + "select case_no, lpad(cast(case_no as varchar), cast(greatest(5, length(cast(case_no as varchar))) as integer), '0') as case_id, perim_idx from cases")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return cases(spark, sf).select("case_no", "case_id", "perim_idx")


@query(
    "j5_hotspots_in_burns", "perimeters ignitions hotspots",
    PAIRS + "select c.case_no, t.det_id, t.sat_ts from cases c join hotspots t on abs(t.x - c.cx) + abs(t.y - c.cy) < c.h and t.sat_ts >= c.discovery",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators.dating import hotspots_in_burns

    return hotspots_in_burns(frame(spark, sf, "hotspots").drop("case_id"), cases(spark, sf).drop("x", "y")).select("case_no", "det_id", "sat_ts")


@query(
    "s21_case_hotspots", "perimeters ignitions hotspots",
    PAIRS + "select lpad(cast(c.case_no as varchar), cast(greatest(5, length(cast(c.case_no as varchar))) as integer), '0') as case_id, c.perim_name, t.det_id, t.sat_ts, t.x, t.y from cases c join hotspots t on abs(t.x - c.cx) + abs(t.y - c.cy) < c.h and t.sat_ts >= c.discovery",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators.dating import listed_in_burns

    path = fresh(spark, "case-hotspots")
    for found in listed_in_burns(frame(spark, sf, "hotspots").select("det_id", "sat_ts", "x", "y"), cases(spark, sf).drop("x", "y")):
        found = found.select("case_id", "perim_name", "x", "y", "hotspots")
        S.write_by_case(found, path, order=("x", "y"), add=True)  # a folder for each case, read back as one table
        let_go(spark)  # only the rows of one share of the cases are shuffled at a time
    return spark.read.schema(found.schema).parquet(path).select("case_id", "perim_name", F.inline("hotspots"), "x", "y")


def simulated(spark: SparkSession, sf: str) -> DataFrame:
    """A simulated burn of each perimeter: a smaller diamond beside it."""
    k = F.col("perim_idx")
    x, y, h = F.col("cx") + (k % 5) * 20, F.col("cy") - (k % 3) * 15, F.col("h") - (k % 4) * 25
    corner = lambda dx, dy: F.struct((x + dx * h).alias("x"), (y + dy * h).alias("y"))
    return frame(spark, sf, "perimeters").select("perim_idx", F.array(F.array(corner(1, 0), corner(0, 1), corner(-1, 0), corner(0, -1))).alias("rings"))


OVERLAP = """
, grid as (
  select perim_idx, abs((u + .5) * 50 - cx) + abs((v + .5) * 50 - cy) < h as o, abs((u + .5) * 50 - sx) + abs((v + .5) * 50 - sy) < sh and perim_idx % 6 > 0 as s
  from (select perim_idx, cx, cy, h, cx + (perim_idx % 5) * 20 as sx, cy - (perim_idx % 3) * 15 as sy, h - (perim_idx % 4) * 25 as sh, unnest(generate_series(-10, 32)) as u from cases) q, generate_series(-10, 32) g(v)
), counts as (select perim_idx, count(*) filter (o) as na, count(*) filter (s) as nb, count(*) filter (o and s) as n_both, count(*) filter (o or s) as domain from grid group by perim_idx)
"""


@query("a3_polygon_scores", FIRES, PAIRS.rstrip() + OVERLAP + "select perim_idx, na, nb, n_both, round(n_both / domain, 6) as jaccard, round(2.0 * n_both / (na + nb), 6) as sorensen, round(nb / na, 6) as ratio_of_areas, round(case when chance = 1 then 0 else (n_both / domain - chance) / (1 - chance) end, 6) as kappa from (select *, (na * nb + (domain - na) * (domain - nb)) / (domain * domain) as chance from counts) k")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Observed against simulated polygons of each case; one in six has no simulation."""
    from ..operators.grids import polygon_scores

    known = once(cases(spark, sf).select("perim_idx", "rings"))
    got = polygon_scores(known, with_observed(spark, sf, known), 50.0, "perim_idx")
    return got.select("perim_idx", "na", "nb", "n_both", *[F.round(c, 6).alias(c) for c in ("jaccard", "sorensen", "ratio_of_areas", "kappa")])


def with_observed(spark: SparkSession, sf: str, known: DataFrame) -> DataFrame:
    """The simulated burns of the known cases, without one in six."""
    return simulated(spark, sf).where("perim_idx % 6 > 0").join(known.select("perim_idx"), "perim_idx", "left_semi")


@query("p39_domain", FIRES, PAIRS.rstrip() + OVERLAP + "select perim_idx, domain from counts")
def _(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators.grids import overlap

    known = once(cases(spark, sf).select("perim_idx", "rings"))
    return overlap(known, with_observed(spark, sf, known), 50.0, "perim_idx").groupBy("perim_idx").agg(F.count("*").alias("domain"))


@query("a17_dissolved", "perimeters", """
with picked as (select *, perim_idx // 8 as case_id from perimeters)
select case_id, n_rings, xmin, ymin, xmax, ymax, area from (
  select case_id, count(*) as n_rings, cast(min(cx - h) as double) as xmin, cast(min(cy - h) as double) as ymin, cast(max(cx + h) as double) as xmax, cast(max(cy + h) as double) as ymax from picked group by case_id) b
join (select case_id, cast(count(distinct (u, v)) * 2500 as double) as area from (select *, unnest(generate_series(-10, 32)) as u from picked) q, generate_series(-10, 32) g(v)
  where abs((u + .5) * 50 - cx) + abs((v + .5) * 50 - cy) < h group by case_id) a using (case_id)
""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Several perimeters made one case each."""
    from ..operators.grids import dissolved

    return dissolved(joined_burns(spark, sf), 50.0).select("case_id", F.size("rings").cast("long").alias("n_rings"), "xmin", "ymin", "xmax", "ymax", "area")


def joined_burns(spark: SparkSession, sf: str) -> DataFrame:
    """Perimeters of neighbouring numbers, made one case."""
    return perimeters(spark, sf).select(F.floor(F.col("perim_idx") / 8).cast("long").alias("case_id"), "rings")


@query("a17_union_area", "perimeters", """
with p as (select perim_idx // 8 as case_id, cx + cy - h as a0, cx + cy + h as a1, cx - cy - h as b0, cx - cy + h as b1 from perimeters),
a as (select case_id, v as lo, lead(v) over (partition by case_id order by v) as hi from (select distinct case_id, unnest([a0, a1]) as v from p) t),
b as (select case_id, v as lo, lead(v) over (partition by case_id order by v) as hi from (select distinct case_id, unnest([b0, b1]) as v from p) t)
select case_id, round(sum(1.0 * (a_hi - a_lo) * (b_hi - b_lo)) / 2, 6) as area from (
  select distinct a.case_id, a.lo as a_lo, a.hi as a_hi, b.lo as b_lo, b.hi as b_hi from a join b using (case_id)
  join p on p.case_id = a.case_id and a0 <= a.lo and a1 >= a.hi and b0 <= b.lo and b1 >= b.hi) c group by case_id
""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Turned by 45 degrees the diamonds are squares, whose union SQL can measure."""
    from ..operators.dissolve import union_area, union_boundary

    return union_area(union_boundary(joined_burns(spark, sf), 200.0)).select("case_id", F.round("area", 6).alias("area"))


@query("a17_total_bounds", FIRES, PAIRS + "select count(*) as n, cast(min(cx - h) as double) as xmin, cast(min(cy - h) as double) as ymin, cast(max(cx + h) as double) as xmax, cast(max(cy + h) as double) as ymax from cases")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return G.with_bounds(cases(spark, sf)).agg(F.count("*").alias("n"), F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"), F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax"))


@query("a17_shoelace_area", "perimeters", "select perim_idx, cast(2 * h * h as double) as area from perimeters")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return perimeters(spark, sf).select("perim_idx", G.shoelace(G.edges_of(F.col("rings"))).alias("area"))


@query("j18_polygon_mask", FIRES, PAIRS + """
select perim_idx, row_no, count(*) as n_cells, min(col_no) as first_col from (
  select perim_idx, r as row_no, c as col_no from cases, generate_series(0, 66) a(r), generate_series(0, 66) b(c)
  where abs((c + .5) * 30 - cx) + abs((2000 - (r + .5) * 30) - cy) < h) group by 1, 2
""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators.grids import polygon_mask

    got = polygon_mask(cases(spark, sf).select("perim_idx", "rings"), xll=0.0, ymax=2000.0, cell=30.0, rows=67, cols=67)
    return got.groupBy("perim_idx", "row_no").agg(F.count("*").alias("n_cells"), F.min("col_no").alias("first_col"))


@query("s1_perimeter_source", "perimeters", "select perim_idx, perim_name, ig_date, acres from perimeters")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Through a Parquet table in the shared folder."""
    path = fresh(spark, "perimeters")
    perimeters(spark, sf).write.parquet(path)
    return S.read_perimeters(spark, path)


@query("s2_ignition_source", "ignitions", "select pt_idx, point_name, date_trunc('second', discovery) as discovery, date_trunc('second', fireout) as fireout, cast(x as double) as x, cast(y as double) as y from ignitions")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Through CSV files in the shared folder."""
    path = fresh(spark, "ignitions")
    times = {k: F.date_format(k, "yyyy-MM-dd HH:mm:ss") for k in ("discovery", "fireout")}
    frame(spark, sf, "ignitions").withColumns(times).write.option("header", True).csv(path)
    return S.read_ignitions(spark, path, "csv")


@query("p28_utm_round_trip", sql="select c_custkey, -126.0 + (c_custkey * 7) % 60 + 0.25 as lon, 24.0 + (c_custkey * 3) % 25 as lat from customer")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Places to their UTM zone's metres and back."""
    lon, lat = -126.0 + (F.col("c_custkey") * 7) % 60 + 0.25, 24.0 + (F.col("c_custkey") * 3) % 25
    at = spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey", lon.alias("lon"), lat.alias("lat")).withColumn("zone", utm_epsg(F.col("lon"), F.col("lat")) - 32600)
    x, y = utm(F.col("lon"), F.col("lat"), F.col("zone"))
    back = utm_inverse(F.col("x"), F.col("y"), F.col("zone"))
    return at.withColumns({"x": x, "y": y}).select("c_custkey", F.round(back[0], 5).alias("lon"), F.round(back[1], 5).alias("lat"))


@query("p28_utm", sql="""
select c_custkey, round(0.9996 * n * (a + (1 - t + c) * a ** 3 / 6 + (5 - 18 * t + t * t + 72 * c - 58 * ep2) * a ** 5 / 120) + 500000, 3) as x,
  round(0.9996 * (6378137.0 * ((1 - e2 / 4 - 3 * e2 ** 2 / 64 - 5 * e2 ** 3 / 256) * p - (3 * e2 / 8 + 3 * e2 ** 2 / 32 + 45 * e2 ** 3 / 1024) * sin(2 * p) + (15 * e2 ** 2 / 256 + 45 * e2 ** 3 / 1024) * sin(4 * p) - (35 * e2 ** 3 / 3072) * sin(6 * p))
    + n * tan(p) * (a * a / 2 + (5 - t + 9 * c + 4 * c * c) * a ** 4 / 24 + (61 - 58 * t + t * t + 600 * c - 330 * ep2) * a ** 6 / 720)), 3) as y
from (select *, 6378137.0 / sqrt(1 - e2 * sin(p) * sin(p)) as n, tan(p) * tan(p) as t, ep2 * cos(p) * cos(p) as c, radians(lon - (6 * (floor((lon + 180) / 6) + 1) - 183)) * cos(p) as a from (
  select c_custkey, -126.0 + (c_custkey * 7) % 60 + 0.25 as lon, radians(24.0 + (c_custkey * 3) % 25) as p, 0.0066943800229 as e2, 0.0066943800229 / (1 - 0.0066943800229) as ep2 from customer) q) r
""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    lon, lat = -126.0 + (F.col("c_custkey") * 7) % 60 + 0.25, 24.0 + (F.col("c_custkey") * 3) % 25
    x, y = utm(lon, lat, utm_epsg(lon, lat) - 32600)
    return spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))


@query("p6_naive_utc", sql="select event_id, ts - interval '7' hour as local_ts, ts as utc_ts from events")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Times of a source in UTC-7, as zoned times and then without a zone."""
    local = F.col("ts") - F.expr("interval 7 hours")
    return spark.read.parquet(f"{sf}/events.parquet").select("event_id", local.alias("local_ts"), X.naive_utc(local, "-07:00").alias("utc_ts"))


@query("p30_safe_divide", sql="select p_partkey, case when p_size % 5 = 0 then 0.0 else p_retailprice / (p_size % 5) end as ratio from part")
def _(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators.reports import safe_divide

    return spark.read.parquet(f"{sf}/part.parquet").select("p_partkey", safe_divide(F.col("p_retailprice"), (F.col("p_size") % 5).cast("double")).alias("ratio"))
