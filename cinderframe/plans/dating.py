"""Queries on hotspots and their times."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..folders import once, shared_folder
from ..functions import geometry as G
from ..operators import dating as D
from ..operators import reports as R
from ..sources import tables as S
from ..streaming import live
from .fixtures import frame, fresh
from .registry import query

GAP_DAYS = 3
DETECTIONS = """
with det as (
  select b.case_id, s.sat_ts, s.x, s.y, cast(b.discovery as timestamp) as discovery, cx, cy, h, 2.0 * h * h as burn
  from spots s join burns b on b.case_id = s.user_id
  where kind not in (4, 5, 10) and s.sat_ts >= try_cast(b.discovery as timestamp) and abs(s.x - cx) + abs(s.y - cy) < h
)"""


def _chain(name: str, source: str, start: str) -> str:
    """The first chain from `start`, of source's rows."""
    return f"""
, {name}_marked as (
  select *, case when date_diff('microsecond', lag(sat_ts) over (partition by case_id order by sat_ts), sat_ts) > {GAP_DAYS * 86400000000} then 1 else 0 end as breaks from {source} where sat_ts >= {start}
), {name} as (select * exclude (breaks, k) from (select *, sum(breaks) over (partition by case_id order by sat_ts range between unbounded preceding and current row) as k from {name}_marked) n where k = 0)"""


def _curve(name: str, source: str, clip: bool = False) -> str:
    """The covered area after each detection of source."""
    within = "and abs((u + .5) * 50 - cx) + abs((v + .5) * 50 - cy) < h" if clip else ""
    return f"""
, {name}_seen as (
  select case_id, u, v, min(sat_ts) as sat_ts from (
    select *, unnest(generate_series(cast(floor((y - 200) / 50.0) as bigint), cast(floor((y + 200) / 50.0) as bigint))) as v from (
      select *, unnest(generate_series(cast(floor((x - 200) / 50.0) as bigint), cast(floor((x + 200) / 50.0) as bigint))) as u from {source}) a) b
  where ((u + .5) * 50 - x) * ((u + .5) * 50 - x) + ((v + .5) * 50 - y) * ((v + .5) * 50 - y) <= 40000 {within} group by case_id, u, v
), {name} as (
  select case_id, sat_ts, cast(sum(sum(n)) over (partition by case_id order by sat_ts) * 2500 as double) as area_m2
  from (select case_id, sat_ts, count(*) as n from {name}_seen group by 1, 2 union all select distinct case_id, sat_ts, 0 from {source}) s group by case_id, sat_ts
)"""


def _time(name: str, curve: str, source: str, fraction: float, least: str = "where target > 0") -> str:
    """When the curve reaches its target, or else the last time."""
    return f"""
, {name} as (
  select a.case_id, coalesce(min(sat_ts) filter (area_m2 >= target), any_value(last)) as t
  from (select c.*, {fraction} * least(max(area_m2) over (partition by c.case_id), burn) as target, last from {curve} c join (select case_id, any_value(burn) as burn, max(sat_ts) as last from {source} group by 1) d on d.case_id = c.case_id) a
  {least} group by a.case_id)"""


FIRST = DETECTIONS + _chain("first", "det", "discovery - interval '1' day")
COVER = FIRST + _curve("curve", "first")
REPORT = DETECTIONS + _chain("first", "det", "discovery") + _curve("curve", "first", clip=True)
TIMES = COVER + _time("lit", "curve", "first", 0.05) + """
, later as (select d.*, t as lit from det d join lit l on l.case_id = d.case_id)""" + _chain("second", "later", "lit") + _curve("curve2", "second") + _time("ended", "curve2", "second", 0.9)
DATED = TIMES + """
, boxed as (
  select b.case_id, count(s.sat_ts) as near, count(*) filter (s.sat_ts >= try_cast(b.discovery as timestamp)) as after from burns b
  left join spots s on s.user_id = b.case_id and s.x between cx - h and cx + h and s.y between cy - h and cy + h group by b.case_id
), dated as (
  select *, case when status = 'SKIP' then null else lit_ts end as start_ts, case when end_ts is not null then least(end_ts, fireout) end as event_end from (
    select b.case_id, b.fireout, b.acres, l.t as lit_ts, e.t as end_ts, (select max(sat_ts) from second s where s.case_id = b.case_id) as chain_end,
      case when kind = 10 then 'discovery is no time' when kind = 4 then 'no burn polygon' when kind = 5 then 'burn polygon empty' when near = 0 then 'no hotspots within the bounds'
        when after = 0 then 'no hotspots after ignition' when n is null then 'no hotspots inside the burn' when l.t is null then 'cover never reached the start fraction' when e.t is null then 'no coverage end' end as reason,
      case when kind = 10 then 'ERROR' when kind in (4, 5) or near = 0 or after = 0 or n is null or l.t is null then 'SKIP' when e.t is null then 'PARTIAL' else 'OK' end as status
    from burns b left join boxed x on x.case_id = b.case_id left join lit l on l.case_id = b.case_id left join ended e on e.case_id = b.case_id
    left join (select case_id, count(*) as n from det group by 1) i on i.case_id = b.case_id) q)
"""
BURNS = "spots burns"


def hot(spark: SparkSession, sf: str) -> DataFrame:
    return frame(spark, sf, "hotspots")


def burns(spark: SparkSession, sf: str) -> DataFrame:
    """The fixture with its diamonds as rings: none for one kind of case, no points for another."""
    corner = lambda dx, dy: F.struct((F.col("cx") + dx * F.col("h")).cast("double").alias("x"), (F.col("cy") + dy * F.col("h")).cast("double").alias("y"))
    rings = F.array(F.array(corner(1, 0), corner(0, 1), corner(-1, 0), corner(0, -1)))
    kind = F.col("kind")
    return frame(spark, sf, "burns").withColumn("rings", F.when(kind == 5, F.slice(rings, 1, 0)).when(kind != 4, rings)).select("case_id", "rings", "discovery", "fireout", "acres")


def spots(spark: SparkSession, sf: str) -> DataFrame:
    return frame(spark, sf, "spots").drop("user_id")


def detections(spark: SparkSession, sf: str) -> DataFrame:
    """(case_id, sat_ts, x, y, discovery, since, burn): hotspots in each readable case's burn from its discovery on; since is a day earlier."""
    cases = burns(spark, sf).withColumn("discovery", F.try_to_timestamp("discovery").cast("timestamp_ntz")).where("size(rings) > 0").withColumn("burn", G.shoelace(G.edges_of(F.col("rings"))))
    inside = G.points_in_polygons(spots(spark, sf), cases, 200.0, F.col("sat_ts") >= F.col("discovery"), "case_id")
    return once(inside.select("case_id", "sat_ts", "x", "y", "discovery", (F.col("discovery") - F.expr("interval 1 day")).alias("since"), "burn"))


def first(spark: SparkSession, sf: str) -> DataFrame:
    return D.in_first_chain(detections(spark, sf), GAP_DAYS, "since")


def dated(spark: SparkSession, sf: str) -> DataFrame:
    return D.dated(burns(spark, sf), spots(spark, sf), gap_days=GAP_DAYS)


@query("p7_hotspot_time", "hotspots", "select det_id, try_strptime(substr(acq_date, 1, 10) || ' ' || lpad(acq_time, 4, '0'), '%Y-%m-%d %H%M') as sat_ts from hotspots")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return D.with_hotspot_time(hot(spark, sf).drop("sat_ts")).select("det_id", "sat_ts")


@query("p8_row_ids", "hotspots", "select case_id, count(*) as n, count(distinct det_id) as ids, min(det_id) as first_id, max(det_id) as last_id from hotspots group by case_id")
def _(spark: SparkSession, sf: str) -> DataFrame:
    from ..schema import require_columns

    return require_columns(hot(spark, sf), "det_id", "case_id").groupBy("case_id").agg(F.count("*").alias("n"), F.countDistinct("det_id").alias("ids"), F.min("det_id").alias("first_id"), F.max("det_id").alias("last_id"))


@query("w3_first_chain", BURNS, FIRST + "select case_id, min(sat_ts) as chain_start, max(sat_ts) as chain_end, count(*) as n from first group by case_id")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """The first of several chains of most cases, from a day before discovery."""
    return D.chains(detections(spark, sf), GAP_DAYS, "since")


@query("a4_covered_area", BURNS, COVER + "select case_id, cast(count(*) * 2500 as double) as area_m2 from curve_seen group by case_id")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return D.covered_area(first(spark, sf))


@query("w4_coverage_curve", BURNS, COVER + "select * from curve")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return D.coverage_curve(first(spark, sf))


@query("w4_clipped_curve", BURNS, REPORT + "select * from curve")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """As the report has it: within the burn only."""
    return report(spark, sf)[0]


def report(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    cases = burns(spark, sf).withColumn("discovery", F.try_to_timestamp("discovery").cast("timestamp_ntz")).withColumn("burn_area_m2", G.shoelace(G.edges_of(F.col("rings"))))
    return D.report_end(detections(spark, sf).select("case_id", "sat_ts", "x", "y"), cases, GAP_DAYS)


@query("a5_fraction_times", BURNS, TIMES + "select l.case_id, l.t as start_ts, e.t as end_ts from lit l left join ended e on e.case_id = l.case_id")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """The 5 % time of the first chain, and the 90 % time of the chain from there."""
    every, areas = detections(spark, sf), burn_areas(spark, sf)
    rows = D.in_first_chain(every, GAP_DAYS, "since")
    lit = once(D.time_to_fraction(D.coverage_curve(rows).join(areas, "case_id"), rows, 0.05, F.col("burn"), "start_ts"))
    later = once(D.in_first_chain(every.join(lit, "case_id"), GAP_DAYS, "start_ts"))
    ended = D.time_to_fraction(D.coverage_curve(later).join(areas, "case_id"), later, 0.9, F.col("burn"), "end_ts")
    return lit.join(ended, "case_id", "left")


def burn_areas(spark: SparkSession, sf: str) -> DataFrame:
    return burns(spark, sf).select("case_id", G.shoelace(G.edges_of(F.col("rings"))).alias("burn"))


@query("w5_first_crossing", BURNS, REPORT + _time("ended", "curve", "first", 0.9, "") + "select case_id, t as sat_end from ended")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return report(spark, sf)[1]


@query("p11_event_end", BURNS, DATED + "select case_id, end_ts, chain_end, event_end from dated")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return dated(spark, sf).select("case_id", F.col("SatelliteEndTime").alias("end_ts"), F.col("SatelliteEnd_chain").alias("chain_end"), F.col("EventEndTime").alias("event_end"))


@query(
    "p12_duration_gate", BURNS,
    DATED + "select case_id, start_ts is not null and end_ts is not null and date_diff('microsecond', start_ts, end_ts) >= 4 * 86400000000 as keep, case when start_ts is null or end_ts is null then 'no satellite times' when date_diff('microsecond', start_ts, end_ts) < 4 * 86400000000 then 'too short' end as reject_reason from dated",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return D.duration_gate(dated(spark, sf), 4 * 24).select("case_id", "keep", "reject_reason")


@query("p13_outcome", BURNS, DATED + "select case_id, status, reason from dated")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Cases of every outcome."""
    return dated(spark, sf).select("case_id", "status", "reason")


@query("j16_apply_results", BURNS, DATED + "select c.case_id, c.acres, d.start_ts, d.end_ts from burns c left join (select * from dated where case_id % 3 > 0) d on d.case_id = c.case_id")
def _(spark: SparkSession, sf: str) -> DataFrame:
    got = dated(spark, sf).where("case_id % 3 > 0").select("case_id", F.col("SatelliteIgnitionTime").alias("start_ts"), F.col("SatelliteEndTime").alias("end_ts"))
    return burns(spark, sf).select("case_id", "acres").join(got, "case_id", "left")


@query("a11_status_rollup", BURNS, DATED + "select coalesce(status, 'total') as status, count(*) as n from dated group by rollup (status)")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return R.status_totals(dated(spark, sf))


@query("w6_normalised_curve", BURNS, COVER + "select case_id, sat_ts, round(case when max(area_m2) over (partition by case_id) <= 0 then area_m2 else area_m2 / max(area_m2) over (partition by case_id) end, 6) as share from curve")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return D.coverage_curve(first(spark, sf)).select("case_id", "sat_ts", F.round(R.normalised("area_m2", "case_id"), 6).alias("share"))


@query("w7_decimated_curve", BURNS, COVER + """
, numbered as (select *, row_number() over (partition by case_id order by sat_ts) - 1 as i, count(*) over (partition by case_id) as n from curve),
wanted as (select distinct case_id, cast(case when n <= 5 then k else round_even(k * (n - 1) / 4.0, 0) end as bigint) as i from (select distinct case_id, n from numbered) c, generate_series(0, 299) g(k) where k < least(n, 5))
select case_id, sat_ts, area_m2 from numbered join wanted using (case_id, i)
""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return R.decimated(D.coverage_curve(first(spark, sf)), "case_id", "sat_ts", 5).select("case_id", "sat_ts", "area_m2")


@query("s22_case_hotspots_crs", "hotspots", "select case_id, min(x) as xmin, max(x) as xmax, min(y) as ymin, max(y) as ymax, case when min(x) >= -180 and max(x) <= 180 and min(y) >= -90 and max(y) <= 90 then 4326 end as epsg from hotspots group by case_id")
def _(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators.cases import assumed_crs

    return assumed_crs(hot(spark, sf))


@query("s3_hotspot_source", "hotspots", "select acq_date, count(*) as n, count(distinct det_id) as detections, min(sat_ts) as first_ts from (select det_id, acq_date, try_strptime(substr(acq_date, 1, 10) || ' ' || lpad(acq_time, 4, '0'), '%Y-%m-%d %H%M') as sat_ts from hotspots) t where sat_ts is not null group by acq_date")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """As a stream over JSON files in the shared folder."""
    path = fresh(spark, "hotspots")
    hot(spark, sf).drop("sat_ts").write.json(path)
    rows = live.drained(S.read_hotspots(spark, path, "json", stream=True), shared_folder(spark))
    return rows.groupBy("acq_date").agg(F.count("*").alias("n"), F.countDistinct("det_id").alias("detections"), F.min("sat_ts").alias("first_ts"))
