"""Queries on runs, their files and case tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..folders import numbered, once
from ..functions.text import case_id
from ..operators import cases as C
from ..operators import runlog as L
from ..sources import tables as S
from .fixtures import frame, fresh
from .registry import query


def log(spark: SparkSession, sf: str) -> DataFrame:
    return frame(spark, sf, "run_log")


STATE = """
with ranked as (select *, row_number() over (partition by case_id order by line_no desc) as back, regexp_extract(text, '=== STEP ([0-9]+):', 1) as s from run_log),
state as (
  select case_id, cast(nullif(max_by(s, line_no) filter (s <> ''), '') as bigint) as step, max_by(regexp_extract(text, '=== STEP [0-9]+:\\s*(\\S+)', 1), line_no) filter (s <> '') as label,
    bool_or(back <= 10 and contains(text, 'CASE COMPLETED.')) as done, bool_or(back <= 60 and contains(text, 'Traceback (most recent call last)')) as failed from ranked group by case_id
), states as (select case_id, case when done then 'done' when step is null then 'starting' when failed then 'failed' else 'running' end as status, step, label from state)
"""


@query("w13_case_state", "run_log", STATE + """
, every as (select case_id from states union select -1 - r_regionkey from region)
select e.case_id, case when e.case_id % 17 = 3 then 'done' when s.case_id is null then 'pending' else status end as status,
  case when e.case_id % 17 = 3 or status = 'done' then 12 else step end as step, label, case when e.case_id % 17 <> 3 and status = 'failed' then error end as error
from every e left join states s using (case_id)
left join (select case_id, min_by(left(trim(text), 52), back) filter (back <= 60 and starts_with(text, 'ValueError:')) as error from ranked group by case_id) x using (case_id)
""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """With cases that have no log, and cases that are done by their outputs."""
    logs = log(spark, sf)
    every = logs.select("case_id").union(spark.read.parquet(f"{sf}/region.parquet").select((-1 - F.col("r_regionkey")).cast("long")))
    return L.case_state(logs, every, logs.select("case_id").where("case_id % 17 = 3"))


@query("t3_status_order", "run_log", STATE + "select case_id, status, row_number() over (order by case status when 'running' then 0 when 'starting' then 1 when 'failed' then 2 when 'done' then 3 else 4 end, case_id) as place from states")
def _(spark: SparkSession, sf: str) -> DataFrame:
    states = L.case_state(log(spark, sf)).select("case_id", "status", L.status_rank(F.col("status")).alias("rank"))
    return numbered(once(states), "rank", "case_id", to="place").select("case_id", "status", F.col("place").cast("int").alias("place"))


@query("w14_elapsed", "run_log", "select case_id, case when s < 0 then s + 86400 else s end as elapsed_s from (select case_id, date_sub('second', min_by(ts, line_no), max_by(ts, line_no)) as s from run_log group by case_id) t")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return L.elapsed(log(spark, sf))


@query("s18_key_values", sql="""
with found as (select user_id as case_id, event_id as line_no, 'k' || event_id % 7 as key, event_id % 5 as value from events),
f as (select *, row_number() over (partition by case_id order by line_no) as nth from found qualify nth <= 20)
select case_id, key, cast(min_by(value, nth) as double) as value from f group by case_id, key union all select user_id, 'Runtime_s', 12.5 from events group by user_id
""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf}/events.parquet")
    pairs = rows.select(F.col("user_id").alias("case_id"), F.col("event_id").alias("line_no"), F.concat(F.lit("k"), (F.col("event_id") % 7).cast("string"), F.lit(" = "), (F.col("event_id") % 5).cast("string")).alias("text"))
    runs = rows.groupBy(F.col("user_id").alias("case_id")).agg(F.max("event_id").alias("line_no")).withColumn("text", F.lit("Runtime : 12.5 s"))
    return L.key_values(pairs.unionByName(runs), 20)


@query("s19_stop_hours", sql="select o_orderkey, o_custkey / 3600.0 as hours from orders")
def _(spark: SparkSession, sf: str) -> DataFrame:
    text = F.concat(F.lit("SIMULATION_TSTOP = "), F.col("o_custkey").cast("string"), F.lit(".0"))
    return spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", L.stop_hours(text).alias("hours"))


@query("s20_log_lines", "run_log", "select lpad(cast(case_id as varchar), 5, '0') as case_id, line_no, text from run_log")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Logs written as text files, a folder for each case, and read back with their line numbers."""
    path = fresh(spark, "logs")
    lines = log(spark, sf).withColumn("case_id", case_id(F.col("case_id")))
    lines.repartition("case_id").sortWithinPartitions("case_id", "line_no").select("case_id", "text").write.partitionBy("case_id").text(path)
    return S.read_log(spark, path).withColumn("case_id", F.regexp_replace("case_id", "^case_id=", ""))


@query("t5_first_lines", "run_log", "select case_id, line_no from run_log qualify row_number() over (partition by case_id order by line_no) <= 24")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return C.first_lines(log(spark, sf), 24).select("case_id", "line_no")


@query("s16_first_existing", "run_log", "select case_id, min(case when text like '%click%' then 1 when text like '%view%' then 2 else 3 end) as priority from run_log group by case_id")
def _(spark: SparkSession, sf: str) -> DataFrame:
    text = F.col("text")
    found = log(spark, sf).select("case_id", F.when(text.contains("click"), 1).when(text.contains("view"), 2).otherwise(3).alias("priority"))
    return C.first_of(found.distinct()).select("case_id", "priority")


@query("s15_newest_file", "run_log", "select case_id, 'out_' || lpad(cast(max(line_no) filter (ts = top) as varchar), 8, '0') || '.tif' as path from (select *, max(ts) over (partition by case_id) as top from run_log) t group by case_id")
def _(spark: SparkSession, sf: str) -> DataFrame:
    name = F.concat(F.lit("out_"), F.lpad(F.col("line_no").cast("string"), 8, "0"), F.lit(".tif"))
    return C.newest(log(spark, sf).select("case_id", name.alias("path"), F.col("ts").alias("modified")))


@query("s17_aliased_points", "ignitions", "select pt_idx, x as lon, y as lat, null::int as epsg from ignitions")
def _(spark: SparkSession, sf: str) -> DataFrame:
    raw = frame(spark, sf, "ignitions").select("pt_idx", F.col("x").alias("Longitude"), F.col("y").alias("LAT"))
    out = C.aliased(raw, {"pt_idx": ("pt_idx",), "lon": ("lon", "x", "longitude"), "lat": ("lat", "y", "latitude"), "epsg": ("epsg",)})
    return out.withColumn("epsg", F.col("epsg").cast("int"))


@query("s6_metadata_json", "case_times", """select case_id, '{"acres":' || acres || ',"discovery":"' || strftime(discovery, '%Y-%m-%dT%H:%M:%S') || '","fireout":' || coalesce('"' || strftime(case when case_id % 5 > 0 then fireout end, '%Y-%m-%dT%H:%M:%S') || '"', 'null') || '}' as json from case_times""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return S.metadata_json(frame(spark, sf, "case_times").withColumn("fireout", F.when(F.col("case_id") % 5 > 0, F.col("fireout"))))


@query("s7_metadata_read", "case_times", "select case_id, acres, date_trunc('second', discovery) as discovery, cast(case_id as varchar) as folder from case_times")
def _(spark: SparkSession, sf: str) -> DataFrame:
    docs = S.metadata_json(frame(spark, sf, "case_times").select("case_id", "acres", "discovery"))
    return S.from_metadata_json(docs, "acres long, discovery timestamp_ntz, folder string").select("case_id", "acres", "discovery", "folder")


@query("s8_metadata_of_existing", "case_times cells", "select case_id, acres from case_times where case_id in (select case_id from cells)")
def _(spark: SparkSession, sf: str) -> DataFrame:
    there = frame(spark, sf, "case_times").join(frame(spark, sf, "cells"), "case_id", "left_semi")
    return S.from_metadata_json(S.metadata_json(there.select("case_id", "acres")), "acres long").select("case_id", "acres")


@query("s14_safe_rows", "perimeters", "select perim_idx, ig_date from perimeters where h > 200")
def _(spark: SparkSession, sf: str) -> DataFrame:
    from .burns import perimeters

    df = perimeters(spark, sf).withColumn("rings", F.when(F.col("h") > 200, F.col("rings")).otherwise(F.array().cast("array<array<struct<x:bigint,y:bigint>>>"))).withColumn("tags", F.create_map(F.lit("a"), F.lit(1))).withColumn("ig_date", F.col("ig_date").cast("timestamp"))
    return S.safe_for_files(df).select("perim_idx", "ig_date")


@query("s12_grid_text", "bands", """
with g as (select distinct case_id from bands), c as (select * from bands where band = 1)
select g.case_id, 6 + r as line_no, string_agg(case when v is null then '-9999' else printf('%.4f', greatest(v, 0.0)) end, ' ' order by k) as line from (
  select g.case_id, r, k, c.value - 10 as v from g, generate_series(0, 9) a(r), generate_series(0, 9) b(k) left join c on c.case_id = g.case_id and c.row_no = r and c.col_no = k) g group by 1, 2
union all select case_id, n, ['ncols 10', 'nrows 10', 'xllcorner 500.000000', 'yllcorner 1000.000000', 'cellsize 30.000000', 'NODATA_value -9999'][n + 1] from g, generate_series(0, 5) h(n)
""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return grid_text(spark, sf)


def grid_text(spark: SparkSession, sf: str) -> DataFrame:
    cells = frame(spark, sf, "bands").where("band = 1").withColumn("value", F.col("value") - 10)
    grids = frame(spark, sf, "bands").select("case_id").distinct().selectExpr("case_id", "10 as ncols", "10 as nrows", "double(500) as xll", "double(1000) as yll", "double(30) as cellsize")
    return S.grid_text(cells, grids)


@query("s11_grid_from_text", "bands", "select case_id, row_no, col_no, 500 + (col_no + .5) * 30 as x, 1300 - (row_no + .5) * 30 as y, greatest(value - 10, 0.0) as value from bands where band = 1")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return S.grid_cells(grid_text(spark, sf)).where("value is not null")


@query("s11_grid_files", "bands", "select case_id, row_no, col_no, 500 + (col_no + .5) * 30 as x, 1300 - (row_no + .5) * 30 as y, greatest(value - 10, 0.0) as value from bands where band = 1")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Through a text file for each case in the shared folder."""
    path = fresh(spark, "grid-files")
    S.write_lines_by_case(grid_text(spark, sf), path)
    return S.grid_cells(S.file_lines(spark, path, "*.txt", S.GRID_FILE)).where("value is not null")


@query("s11_grid_header", "bands", "select distinct case_id, 10 as ncols, 10 as nrows, 500.0::double as xmin, 1000.0::double as ymin, 800.0::double as xmax, 1300.0::double as ymax from bands")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return S.grid_header(grid_text(spark, sf)).select("case_id", "ncols", "nrows", F.col("xll").alias("xmin"), F.col("yll").alias("ymin"), "xmax", "ymax")


@query("s4_case_csv", "case_times", "select lpad(cast(case_id as varchar), 5, '0') as folder, case_id as perim_idx, date_trunc('second', discovery) as point_discovery, null::timestamp as \"EventEndTime\" from case_times")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Through a CSV file in the shared folder and back."""
    path = fresh(spark, "cases")
    S.write_cases(case_rows(spark, sf), path)
    return S.read_cases(spark, path).select("folder", "perim_idx", "point_discovery", "EventEndTime")


def case_rows(spark: SparkSession, sf: str) -> DataFrame:
    return frame(spark, sf, "case_times").select(case_id(F.col("case_id")).alias("folder"), F.col("case_id").alias("perim_idx"), F.date_trunc("second", "discovery").cast("timestamp_ntz").alias("point_discovery"))


@query("s5_case_csv_sink", "case_times", "select lpad(cast(case_id as varchar), 5, '0') as folder, cast(case_id as varchar) as perim_idx, strftime(discovery, '%Y-%m-%dT%H:%M:%S.000') as point_discovery from case_times where case_id % 2 = 0")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """What the second of two writes left in the file, as text."""
    path = fresh(spark, "cases")
    S.write_cases(case_rows(spark, sf), path)
    S.write_cases(case_rows(spark, sf).where("perim_idx % 2 = 0"), path)
    return spark.read.option("header", True).csv(path)


@query("s8_metadata_sink", "case_times cells", """select case_id, '{"acres":' || acres || '}' as json from case_times where case_id in (select case_id from cells)""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """A JSON file folder for each case that exists, read back."""
    path = fresh(spark, "metadata")
    S.write_metadata(frame(spark, sf, "case_times").select("case_id", "acres"), frame(spark, sf, "cells").select("case_id").distinct(), path)
    return spark.read.schema("value string, case_id long").text(path).select("case_id", F.col("value").alias("json"))


@query("s15_newest_of_files", sql="select k % 3 as case_id, max(k) as number from (select row_number() over (order by n_nationkey) - 1 as k from nation) t group by 1")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Of three rounds of files the last, by the times at which they were written."""
    path = fresh(spark, "files")
    keys = spark.read.parquet(f"{sf}/nation.parquet").select(F.col("n_nationkey").alias("k"))
    for least, most in ((0, 8), (9, 17), (18, 24)):
        rows = keys.where(F.col("k").between(least, most)).withColumn("case_id", F.col("k") % 3)
        rows.groupBy("case_id").agg(F.max("k").cast("string").alias("text")).repartition("case_id").write.mode("append").partitionBy("case_id").text(path)
    files = S.files_of(spark, f"{path}/*/*.txt").select("path", "modified", F.regexp_extract("case_id", r"([0-9]+)$", 1).cast("long").alias("case_id"))
    last = C.newest(files).select("case_id", F.regexp_replace("path", r"^file:/*", "/").alias("path"))
    texts = spark.read.text(f"{path}/*/*.txt").select(F.regexp_replace(F.col("_metadata.file_path"), r"^file:/*", "/").alias("path"), F.col("value").cast("long").alias("number"))
    return last.join(texts, "path").select("case_id", "number")


@query("s18_last_csv_row", sql="""
with l as (select user_id as case_id, max(event_id) as last from events group by user_id)
select case_id, unnest(['cells', 'hours']) as key, unnest([cast(last % 97 as varchar), cast(last % 13 as varchar) || '.5']) as value from l
""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf}/events.parquet")
    text = F.concat((F.col("event_id") % 97).cast("string"), F.lit(", "), (F.col("event_id") % 13).cast("string"), F.lit(".5"))
    lines = rows.select(F.col("user_id").alias("case_id"), (F.col("event_id") + 1).alias("line_no"), text.alias("text"))
    heads = rows.select(F.col("user_id").alias("case_id"), F.lit(-1).cast("long").alias("line_no"), F.lit("cells,hours").alias("text")).distinct()
    return L.last_csv_row(lines.unionByName(heads))


@query("j8_product_year", "perimeters", f"select perim_idx, coalesce((select max(y) from (values {', '.join(f'({y})' for y in config.PRODUCT_YEARS)}) p(y) where y <= year(ig_date) + 25), {min(config.PRODUCT_YEARS)}) as product_year from perimeters")
def _(spark: SparkSession, sf: str) -> DataFrame:
    years = spark.createDataFrame([(y,) for y in config.PRODUCT_YEARS], "product_year int")
    return C.product_years(frame(spark, sf, "perimeters").select("perim_idx", (F.year("ig_date") + 25).alias("year")), years).select("perim_idx", "product_year")


@query("j14_selected_cases", "case_times cells run_log", """
select case_id from case_times where case_id in (select case_id from run_log where contains(text, 'Traceback')) and case_id not in (select case_id from cells)
""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    named = C.numeric_cases(frame(spark, sf, "case_times").withColumn("name", F.col("case_id").cast("string")))
    wanted = log(spark, sf).where(F.col("text").contains("Traceback")).select("case_id").distinct()
    return C.selected(named, wanted, frame(spark, sf, "cells").select("case_id").distinct())[0].select("case_id")


@query("j17_case_lookup", "case_times", "select case_id, acres from case_times")
def _(spark: SparkSession, sf: str) -> DataFrame:
    folders = frame(spark, sf, "case_times").select(case_id(F.col("case_id")).alias("folder"))
    return folders.withColumn("case_id", F.col("folder").cast("long")).join(frame(spark, sf, "case_times"), "case_id").select("case_id", "acres")


@query("t2_sorted_summary", "case_times", "select case_id, acres, row_number() over (order by case_id) as place from case_times")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return numbered(once(frame(spark, sf, "case_times").select("case_id", "acres")), "case_id", to="place").withColumn("place", F.col("place").cast("int"))
