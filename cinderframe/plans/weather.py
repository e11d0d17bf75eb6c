"""Queries on hourly weather and the times of fires."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.projections import A, E2
from ..functions.text import time_key
from ..operators import cases as C
from ..operators import grids as G
from ..operators import nearest as N
from ..operators import weather as W
from ..sources import tables as S
from .fixtures import frame, fresh
from .registry import query

WINDOWS = "with fires as (select user_id % 10 as case_id, min(ts) + interval '5' hour as start_ts, max(ts) - interval '50' hour as end_ts from events group by 1) "


def weather(spark: SparkSession, sf: str) -> DataFrame:
    return frame(spark, sf, "weather_hourly")


def fires(spark: SparkSession, sf: str) -> DataFrame:
    events = spark.read.parquet(f"{sf}/events.parquet")
    return events.groupBy((F.col("user_id") % 10).alias("case_id")).agg((F.min("ts") + F.expr("interval 5 hours")).alias("start_ts"), (F.max("ts") - F.expr("interval 50 hours")).alias("end_ts"))


ROUNDED = """select case_id, ts, cast(round_even(temp_c, 0) as bigint) as temp_c, cast(greatest(0, least(99, round_even(rh, 0))) as bigint) as rh, pcp_mm, cast(round_even(wind_kph, 0) as bigint) as wind_kph,
  (cast(round_even(wind_dir_deg, 0) as bigint) % 360 + 360) % 360 as wind_dir_deg, cast(greatest(0, least(100, cloud_pct)) as bigint) as cloud_pct from weather_hourly"""


@query("p14_rounded_weather", "weather_hourly", f"select case_id, ts, temp_c, rh, round(pcp_mm, 6) as pcp_mm, wind_kph, wind_dir_deg, cloud_pct from ({ROUNDED}) t")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return W.rounded(weather(spark, sf)).withColumn("pcp_mm", F.round("pcp_mm", 6))


@query("p15_whole_rain", "weather_hourly", "select case_id, ts, cast(round_even(pcp_mm, 0) as bigint) as pcp_mm from weather_hourly")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return W.whole_rain(weather(spark, sf)).select("case_id", "ts", "pcp_mm")


@query("p16_model_units", "weather_hourly", """
select case_id, ts, round(temp_c + 273.15 - 273.15, 6) as temp_c, round(sqrt(u * u + v * v) * 3.6, 6) as wind_kph, round(case when d < 0 then d + 360 when d >= 360 then d - 360 else d end, 6) as wind_dir_deg, round(case when cloud <= 1.5 then cloud * 100 else cloud end, 6) as cloud_pct
from (select *, 270 - degrees(atan2(v, u)) as d from (select case_id, ts, temp_c, wind_kph / 10.0 - 5 as u, rh / 20.0 - 3.3 as v, cloud_pct / 100.0 as cloud from weather_hourly) a) b
""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    raw = weather(spark, sf).select("case_id", "ts", (F.col("temp_c") + 273.15).alias("temp_k"), (F.col("wind_kph") / 10.0 - 5).alias("u_ms"), (F.col("rh") / 20.0 - 3.3).alias("v_ms"), (F.col("cloud_pct") / 100.0).alias("cloud"))
    return W.from_model(raw).select("case_id", "ts", *[F.round(c, 6).alias(c) for c in ("temp_c", "wind_kph", "wind_dir_deg", "cloud_pct")])


EDGES = {
    "sink": ("date_trunc('hour', start_ts)", "date_trunc('hour', end_ts + interval '1' hour)"), "wxs": ("date_trunc('hour', start_ts)", "date_trunc('hour', end_ts)"),
    "model": ("date_trunc('hour', start_ts - interval '1' hour)", "date_trunc('hour', end_ts + interval '1' hour)"), "legacy": ("start_ts", "end_ts"),
}


@query("j9_weather_windows", "weather_hourly", WINDOWS + " union all ".join(f"select '{m}' as mode, w.case_id, w.ts from weather_hourly w join fires f on f.case_id = w.case_id and w.ts between {a} and {b}" for m, (a, b) in EDGES.items()))
def _(spark: SparkSession, sf: str) -> DataFrame:
    out = None
    for mode in W.MODES:
        part = W.in_window(weather(spark, sf), fires(spark, sf), mode).select(F.lit(mode).alias("mode"), "case_id", "ts")
        out = part if out is None else out.unionByName(part)
    return out


@query("a8_mean_wind", "weather_hourly", WINDOWS + """
select w.case_id, round(coalesce(avg(wind_kph) filter (w.ts between date_trunc('hour', start_ts) and date_trunc('hour', end_ts + interval '1' hour)), avg(wind_kph)), 6) as wind_kph
from weather_hourly w left join fires f on f.case_id = w.case_id and w.case_id % 4 > 0 group by w.case_id
""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return W.mean_wind(weather(spark, sf), fires(spark, sf).where("case_id % 4 > 0")).withColumn("wind_kph", F.round("wind_kph", 6))


@query("p32_burn_periods", sql=WINDOWS + """
select case_id, month(d) as month, day(d) as day, case when d = cast(start_ts as date) then strftime(start_ts, '%H%M') else '0000' end as "from", case when d = cast(end_ts as date) then strftime(end_ts, '%H%M') else '2359' end as "to"
from (select *, cast(unnest(generate_series(cast(start_ts as date), cast(end_ts as date), interval '1' day)) as date) as d from fires) t
""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return W.burn_periods(fires(spark, sf))


@query("p33_split_windows", sql=WINDOWS + "select case_id, s as from_ts, least(s + interval '13' day, end_ts) as to_ts from (select *, unnest(generate_series(start_ts, end_ts, interval '13' day)) as s from fires) t where s < end_ts")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return W.split_windows(fires(spark, sf))


@query("p34_wind_schedule", "bands", WINDOWS + "select b.case_id, b.band, month(t) as month, day(t) as day, strftime(t, '%H%M') as hhmm from (select distinct case_id, band from bands) b join fires f on f.case_id = b.case_id, lateral (select start_ts + to_hours(cast(band - 1 as integer)) as t) l where t <= end_ts")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return W.wind_schedule(fires(spark, sf), frame(spark, sf, "bands"))


@query("p26_stop_and_hour", sql=WINDOWS + "select case_id, date_sub('second', start_ts, end_ts) as stop_s, year(start_ts) as year, cast(floor(date_sub('second', date_trunc('year', start_ts), start_ts) / 3600.0) as bigint) as hour_of_year from fires where end_ts > start_ts")
def _(spark: SparkSession, sf: str) -> DataFrame:
    cells = frame(spark, sf, "cells").groupBy("case_id").agg(F.min("row_no").alias("row_no"), F.min("col_no").alias("col_no"))
    return C.scenario_rows(fires(spark, sf), cells, frame(spark, sf, "bands")).select("case_id", "stop_s", "year", "hour_of_year")


def utm_grids(df: DataFrame) -> DataFrame:
    """A grid of 30 m cells for each case, in a zone of its own."""
    case = F.col("case_id")
    return df.select("case_id").distinct().select("case_id", (400_000.0 + case * 1000).alias("xll"), (4_200_000.0 + case * 5000).alias("ymax"), F.lit(30.0).alias("cell"), (10 + case % 9).alias("zone"))


# The series of the inverse projection, written out; its constants are those of the ellipsoid.
E1 = (1 - (1 - E2) ** 0.5) / (1 + (1 - E2) ** 0.5)
PLACES = f"""
, at0 as (select *, 400000.0 + case_id * 1000 + (col_no + .5) * 30 as x, 4200000.0 + case_id * 5000 - (row_no + .5) * 30 as y, 10 + case_id % 9 as zone from placed),
at1 as (select *, y / 0.9996 / {A * (1 - E2 / 4 - 3 * E2**2 / 64 - 5 * E2**3 / 256)!r} as mu from at0),
at2 as (select *, mu + {3 * E1 / 2 - 27 * E1**3 / 32!r} * sin(2 * mu) + {21 * E1**2 / 16 - 55 * E1**4 / 32!r} * sin(4 * mu) + {151 * E1**3 / 96!r} * sin(6 * mu) + {1097 * E1**4 / 512!r} * sin(8 * mu) as p from at1),
at3 as (select *, {E2 / (1 - E2)!r} * cos(p) ** 2 as c, tan(p) ** 2 as t, {A!r} / sqrt(1 - {E2!r} * sin(p) ** 2) as n, {A * (1 - E2)!r} / (1 - {E2!r} * sin(p) ** 2) ** 1.5 as r from at2),
at4 as (select *, (x - 500000) / (n * 0.9996) as d, {E2 / (1 - E2)!r} as g from at3),
known as (select *, round(6 * zone - 183 + degrees((d - (1 + 2 * t + c) * d ** 3 / 6 + (5 - 2 * c + 28 * t - 3 * c * c + 8 * g + 24 * t * t) * d ** 5 / 120) / cos(p)), 6) as lon,
  round(degrees(p - n * tan(p) / r * (d * d / 2 - (5 + 3 * t + 10 * c - 4 * c * c - 9 * g) * d ** 4 / 24 + (61 + 90 * t + 298 * c + 45 * t * t - 252 * g - 3 * c * c) * d ** 6 / 720)), 6) as lat from at4)
"""


@query("p35_scenario_places", "cells", WINDOWS + ", placed as (select case_id, row_no, col_no from cells where fuel >= 101 qualify row_number() over (partition by case_id order by greatest(abs(row_no - 20), abs(col_no - 20)), (row_no - 20) * (row_no - 20) + (col_no - 20) * (col_no - 20), row_no, col_no) = 1)" + PLACES + "select f.case_id, x, y, lon, lat, date_sub('second', start_ts, end_ts) as stop_s from fires f join known k on k.case_id = f.case_id where end_ts > start_ts")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Where each case starts to burn."""
    cells = frame(spark, sf, "cells")
    starts = cells.select("case_id").distinct().withColumn("row0", F.lit(20)).withColumn("col0", F.lit(20))
    rows = C.scenario_rows(fires(spark, sf), G.nearest_valid(cells, starts).drop("moved"), frame(spark, sf, "bands"))
    return G.with_places(rows, utm_grids(cells)).select("case_id", "x", "y", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"), "stop_s")


@query("p36_request_places", "bands", WINDOWS + """
, placed as (select * from (select *, greatest(abs(row_no - (max(row_no) over p + 1) // 2), abs(col_no - (max(col_no) over p + 1) // 2)) as off from bands where band = 1 window p as (partition by case_id)) q
  qualify row_number() over (partition by case_id order by off, row_no, col_no, value) = 1)""" + PLACES + "select f.case_id, start_ts - interval '20' day as from_ts, end_ts as to_ts, lon, lat, value as elevation from fires f join known k on k.case_id = f.case_id")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """The place of which each fire needs the weather."""
    dem = frame(spark, sf, "bands").where("band = 1")
    rows = W.request_windows(fires(spark, sf), dem)[0]
    return G.with_places(rows, utm_grids(dem)).select("case_id", "from_ts", "to_ts", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"), "elevation")


@query("p35_scenario_rows", "cells bands", WINDOWS + """
, snapped as (select case_id, row_no, col_no from cells where fuel >= 101 qualify row_number() over (partition by case_id order by greatest(abs(row_no - 20), abs(col_no - 20)), (row_no - 20) * (row_no - 20) + (col_no - 20) * (col_no - 20), row_no, col_no) = 1)
select f.case_id, s.row_no, s.col_no, date_sub('second', start_ts, end_ts) as stop_s, year(start_ts) as year, cast(floor(date_sub('second', date_trunc('year', start_ts), start_ts) / 3600.0) as bigint) as hour_of_year, coalesce(b.bands, 0) as bands
from fires f join snapped s on s.case_id = f.case_id left join (select case_id, count(distinct band) as bands from bands group by 1) b on b.case_id = f.case_id where end_ts > start_ts
""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    cells = frame(spark, sf, "cells")
    starts = cells.select("case_id").distinct().withColumn("row0", F.lit(20)).withColumn("col0", F.lit(20))
    return C.scenario_rows(fires(spark, sf), G.nearest_valid(cells, starts).drop("moved"), frame(spark, sf, "bands"))


@query("p36_weather_requests", "bands", WINDOWS + """
select f.case_id, start_ts - interval '20' day as from_ts, end_ts as to_ts, b.row_no, b.col_no, b.value as elevation from fires f
join (select * from (select *, greatest(abs(row_no - (max(row_no) over p + 1) // 2), abs(col_no - (max(col_no) over p + 1) // 2)) as d from bands where band = 1 window p as (partition by case_id)) t
  qualify row_number() over (partition by case_id order by d, row_no, col_no, value) = 1) b on b.case_id = f.case_id
""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return W.request_windows(fires(spark, sf), frame(spark, sf, "bands").where("band = 1"))[0]


@query("j10_nearest_point", sql="""
select case_id, point_id, round(d2, 6) as d2 from (select c_custkey as point_id, c_nationkey as case_id, (c_acctbal / 100 - case_id) * (c_acctbal / 100 - case_id) + (c_custkey % 90 - 45) * (c_custkey % 90 - 45) as d2 from customer) t
qualify row_number() over (partition by case_id order by d2, point_id) = 1
""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    grid = spark.read.parquet(f"{sf}/customer.parquet").select(F.col("c_nationkey").alias("case_id"), F.col("c_custkey").alias("point_id"), (F.col("c_acctbal") / 100).alias("lon"), (F.col("c_custkey") % 90).alias("lat"))
    places = spark.read.parquet(f"{sf}/nation.parquet").select(F.col("n_nationkey").alias("case_id"), F.col("n_nationkey").alias("lon0"), F.lit(45).alias("lat0"))
    return N.nearest_point(grid, places).withColumn("d2", F.round("d2", 6))


@query("j10_nearest_of_shared", sql="""
select n_nationkey as case_id, c_custkey as point_id, round((c_acctbal / 100 - n_nationkey * 4) * (c_acctbal / 100 - n_nationkey * 4) + (c_custkey % 90 - 45.25) * (c_custkey % 90 - 45.25), 6) as d2 from customer, nation
qualify row_number() over (partition by n_nationkey order by (c_acctbal / 100 - n_nationkey * 4) * (c_acctbal / 100 - n_nationkey * 4) + (c_custkey % 90 - 45.25) * (c_custkey % 90 - 45.25), c_custkey) = 1
""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """All places share one grid."""
    grid = spark.read.parquet(f"{sf}/customer.parquet").select(F.col("c_custkey").alias("point_id"), (F.col("c_acctbal") / 100).alias("lon"), (F.col("c_custkey") % 90).alias("lat"))
    places = spark.read.parquet(f"{sf}/nation.parquet").select(F.col("n_nationkey").alias("case_id"), (F.col("n_nationkey") * 4).alias("lon0"), F.lit(45.25).alias("lat0"))
    return N.nearest_point(grid, places).withColumn("d2", F.round("d2", 6))


@query("w8_after_conditioning", "weather_hourly", "select case_id, ts, row_number() over (partition by case_id order by ts) - 480 as nth from weather_hourly qualify nth > 0")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return W.after_conditioning(weather(spark, sf)).select("case_id", "ts", "nth")


@query("w9_first_and_last", "weather_hourly", "select case_id, min(ts) as first_ts, max(ts) as last_ts from weather_hourly group by case_id")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return W.first_and_last(weather(spark, sf))


@query("s10_weather_text", "weather_hourly", f"""
select case_id, row_number() over (partition by case_id order by ts) + 4 as line_no, printf('%4d %2d %2d %04d %4d %3d %7.3f %3d %3d %3d', year(ts), month(ts), day(ts), hour(ts) * 100 + minute(ts), temp_c, rh, floor(pcp_mm * 1000) / 1000, wind_kph, wind_dir_deg, cloud_pct) as line from ({ROUNDED}) t
union all select case_id, n, case n when 1 then 'RAWS_ELEVATION: ' || (100 + case_id) when 2 then 'RAWS_UNITS: METRIC' when 3 then 'RAWS_WINDS: OpenMeteo_ERA5_center_of_DEM' else 'Year Mth Day Time Temp RH HrlyPcp WindSpd WindDir CloudCov' end
from (select distinct case_id from weather_hourly) c, generate_series(1, 4) g(n)
""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return W.text_lines(weather(spark, sf).withColumn("pcp_mm", F.floor(F.col("pcp_mm") * 1000) / 1000), weather(spark, sf).select("case_id").distinct().withColumn("elevation", F.col("case_id") + 100.0))


@query("s9_weather_from_text", "weather_hourly", f"select case_id, ts, cast(temp_c as double) as temp_c, cast(rh as double) as rh, floor(pcp_mm * 1000) / 1000 as pcp_mm, cast(wind_kph as double) as wind_kph, cast(wind_dir_deg as double) as wind_dir_deg, cast(cloud_pct as double) as cloud_pct from ({ROUNDED}) t")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return W.from_text(W.text_lines(weather(spark, sf).withColumn("pcp_mm", F.floor(F.col("pcp_mm") * 1000) / 1000), weather(spark, sf).select("case_id").distinct().withColumn("elevation", F.lit(12.5))))


@query("s9_weather_files", "weather_hourly", f"select case_id, ts, cast(temp_c as double) as temp_c, cast(rh as double) as rh, floor(pcp_mm * 1000) / 1000 as pcp_mm, cast(wind_kph as double) as wind_kph, cast(wind_dir_deg as double) as wind_dir_deg, cast(cloud_pct as double) as cloud_pct from ({ROUNDED}) t")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Through a text file for each case in the shared folder."""
    path, rows = fresh(spark, "weather-files"), weather(spark, sf).withColumn("pcp_mm", F.floor(F.col("pcp_mm") * 1000) / 1000)
    S.write_lines_by_case(W.text_lines(rows, rows.select("case_id").distinct().withColumn("elevation", F.lit(12.5))), path)
    return W.from_text(S.file_lines(spark, path, "*.txt", S.WEATHER_FILE))


@query("p24_time_keys", "weather_hourly", "select case_id, ts as key_ts from weather_hourly")
def _(spark: SparkSession, sf: str) -> DataFrame:
    names = weather(spark, sf).select("case_id", F.concat(F.lit("grid_"), F.date_format("ts", "MM-dd-yyyy_HHmm"), F.lit("_30m_vel.asc")).alias("name"))
    return names.select("case_id", time_key(F.col("name")).alias("key_ts"))


@query("u1_stacked_grids", "weather_hourly", "select case_id, ts, dense_rank() over (partition by case_id order by ts) as band, round(temp_c, 6) as value from weather_hourly")
def _(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.sql import Window

    rows = weather(spark, sf)
    both = rows.where("hour(ts) < 12").unionByName(rows.where("hour(ts) >= 12"))
    return both.select("case_id", "ts", F.dense_rank().over(Window.partitionBy("case_id").orderBy("ts")).alias("band"), F.round("temp_c", 6).alias("value"))


@query("u2_guarded_union", "weather_hourly", "select case_id, ts from weather_hourly")
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = weather(spark, sf).select("case_id", "ts")
    return C.guarded_union([rows.where("hour(ts) < 12"), rows.where("hour(ts) >= 12")], ["case_id", "ts"])
