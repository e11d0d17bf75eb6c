"""Streaming queries over the event table, drained into files, with batch twins in SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..folders import once, shared_folder
from ..streaming import live
from .fixtures import frame
from .registry import query
from .runs import STATE


#: A batch of lines comes in a file for each so many lines of the log, and in 4 at least.
LINES_OF_FILE = 2**20


def events(spark: SparkSession, sf: str) -> DataFrame:
    path = f"{sf}/events.parquet"
    # The pattern lets the stream read a table that is one file, too.
    rows = spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{sf}/events.parque[t]")
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def hotspots(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf).select(F.col("user_id").alias("case_id"), F.col("ts").alias("sat_ts"), ((F.col("event_id") * 7919) % 3000).alias("x"), ((F.col("event_id") * 104729) % 3000).alias("y"))


@query("x1_live_chains", sql="""
with m as (select user_id, ts, case when date_diff('microsecond', lag(ts) over (partition by user_id order by ts), ts) > 43200000000 then 1 else 0 end as b from events),
s as (select *, sum(b) over (partition by user_id order by ts range between unbounded preceding and current row) as k from m)
select user_id as case_id, min(ts) as chain_start, max(ts) as chain_end, count(*) as n from s group by user_id, k
having max(ts) + interval '12' hour <= (select max(ts) - interval '1' day from events)
""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    out = live.drained(live.chains(hotspots(spark, sf), "12 hours"), shared_folder(spark))
    return out.select("case_id", F.col("chain_start").cast("timestamp_ntz").alias("chain_start"), F.col("chain_end").cast("timestamp_ntz").alias("chain_end"), "n")


@query("x2_live_cover", sql="""
with m as (select user_id, event_id, ts, case when date_diff('microsecond', lag(ts) over (partition by user_id order by ts), ts) > 43200000000 then 1 else 0 end as b from events),
s as (select *, sum(b) over (partition by user_id order by ts range between unbounded preceding and current row) as k from m),
c as (select user_id, k, min(ts) as chain_start from s group by user_id, k having max(ts) + interval '12' hour <= (select max(ts) - interval '1' day from events)),
d as (select user_id, k, (event_id * 7919) % 3000 as x, (event_id * 104729) % 3000 as y from s),
g as (
  select distinct user_id, k, u, v from (
    select *, unnest(generate_series(cast(floor((y - 200) / 100.0) as bigint), cast(floor((y + 200) / 100.0) as bigint))) as v from (
      select *, unnest(generate_series(cast(floor((x - 200) / 100.0) as bigint), cast(floor((x + 200) / 100.0) as bigint))) as u from d) a) b
  where ((u + .5) * 100 - x) * ((u + .5) * 100 - x) + ((v + .5) * 100 - y) * ((v + .5) * 100 - y) <= 40000)
select user_id as case_id, chain_start, count(*) as cells from c join g using (user_id, k) group by user_id, chain_start
""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    out = live.drained(live.covered_cells(hotspots(spark, sf), 200.0, 100.0), shared_folder(spark))
    return out.withColumn("chain_start", F.col("chain_start").cast("timestamp_ntz"))


@query("x3_live_status", sql="""
select user_id as case_id, max_by(event_id % 12 + 1, event_id) filter (event_type <> 'error') as step, bool_or(event_type = 'error') as failed from events group by user_id
""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    text = F.when(F.col("event_type") == "error", "Traceback (most recent call last)").otherwise(F.concat(F.lit("=== STEP "), (F.col("event_id") % 12 + 1).cast("string"), F.lit(": "), F.col("event_type"), F.lit(" ===")))
    log = events(spark, sf).select(F.col("user_id").alias("case_id"), F.col("event_id").alias("line_no"), text.alias("text"))
    return live.drained(live.case_status(log), shared_folder(spark), "update")


@query("x3_live_tail", "run_log", STATE + """
, errors as (select case_id, min_by(left(trim(text), 52), back) filter (back <= 60 and starts_with(text, 'ValueError:')) as error from ranked group by case_id)
select s.case_id, status, case when status = 'done' then 12 else step end as step, label, case when status = 'failed' then error end as error from states s join errors e using (case_id)
""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """By the last 60 lines of each case, which come in several batches."""
    path, log = f"{shared_folder(spark)}/lines-{uuid.uuid4().hex}", once(frame(spark, sf, "run_log").select("case_id", F.col("line_no").cast("long").alias("line_no"), "text"))
    files = max(4, log.count() // LINES_OF_FILE)
    for k in range(3):  # files are read in the order in which they were written
        log.where((F.col("line_no") * 7 + F.col("case_id")) % 3 == k).repartition(files).write.mode("append").parquet(path)
    rows = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", files).parquet(path)
    return live.drained(live.case_tail(rows), shared_folder(spark), "update")


@query("x4_late_detections", sql="""
with e as (select user_id as case_id, event_id % 3 as part, date_trunc('hour', ts) as hour, ts from events),
w as (select max(ts) filter (part = 0) - interval '6' hour as first_mark, max(ts) - interval '6' hour as last_mark from e)
select cast(null as bigint) as batch, case_id, hour, count(*) as n, cast(null as bigint) as late
from e, w where hour + interval '1' hour <= last_mark and (part < 2 or hour + interval '1' hour > first_mark) group by case_id, hour
union all select 2, null, null, null, count(*) from e, w where part = 2 and hour + interval '1' hour <= first_mark
""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Hotspots of closed hours by case, and how many rows of each batch came too late, whole hours of them included: the table arrives in three batches, each as old as the others."""
    path, files = f"{shared_folder(spark)}/arrivals-{uuid.uuid4().hex}", 8
    table = spark.read.parquet(f"{sf}/events.parquet").select(F.col("event_id").alias("det_id"), F.col("user_id").alias("case_id"), F.col("ts").cast("timestamp").alias("sat_ts"))
    for k in range(3):  # files are read in the order in which they were written
        table.where(F.col("det_id") % 3 == k).repartition(files).write.mode("append").parquet(path)
    rows = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", files).parquet(path)
    counted, late = live.drained_with_late(live.closed_hours(rows), shared_folder(spark))
    hours = counted.select(F.lit(None).cast("long").alias("batch"), "case_id", F.col("hour").cast("timestamp_ntz").alias("hour"), "n", F.lit(None).cast("long").alias("late"))
    return hours.unionByName(late.groupBy("batch").agg(F.sum("late").alias("late")), allowMissingColumns=True)


@query("x5_live_wind", sql="""
select user_id % 10 as case_id, date_trunc('hour', ts) as hour, round(avg(value / 2.0), 6) as wind_kph, count(*) as n from events group by 1, 2
having date_trunc('hour', ts) + interval '1' hour <= (select max(ts) - interval '1' hour from events)
""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    weather = events(spark, sf).select((F.col("user_id") % 10).alias("case_id"), "ts", (F.col("value") / 2.0).alias("wind_kph"))
    out = live.drained(live.hourly_wind(weather), shared_folder(spark))
    return out.select("case_id", F.col("hour").cast("timestamp_ntz").alias("hour"), F.round("wind_kph", 6).alias("wind_kph"), "n")
