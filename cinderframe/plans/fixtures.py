"""Fire tables derived from the driver's tables, with one SQL text for Spark and DuckDB."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..folders import shared_folder

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

FIXTURES = {
    "perimeters": """
        select o.o_orderkey as perim_idx, c.c_name as perim_name, o.o_orderdate as ig_date, o.o_totalprice/40.0 as acres,
               (o.o_orderkey*37)%1000 as cx, (o.o_orderkey*91)%1000 as cy, 150+(o.o_orderkey%7)*40 as h
        from {orders} o join {customer} c on o.o_custkey=c.c_custkey""",
    "ignitions": """
        select l.l_orderkey*10+l.l_linenumber as pt_idx,
               case when l.l_orderkey%50=0 then 'Unnamed' else replace(lower(max(c.c_name)),'#','-') end as point_name,
               min(l.l_shipdate) as discovery,
               case when l.l_linenumber=7 then null else min(l.l_shipdate) + interval '20' day end as fireout,
               (min(l.l_partkey)*13)%1000 as x, (l.l_orderkey*29+l.l_linenumber*57)%1000 as y
        from {lineitem} l join {customer} c on c.c_custkey = l.l_orderkey % (select count(*) from {customer})
        group by l.l_orderkey, l.l_linenumber""",
    "hotspots": """
        select event_id as det_id, user_id as case_id, ts as sat_ts, cast(cast(ts as date) as string) as acq_date,
               cast(hour(ts)*100+minute(ts) as string) as acq_time, (event_id*7919)%3000 as x, (event_id*104729)%3000 as y
        from {events}""",
    "cells": """
        select case_id, row_no, col_no, case when min(q)>25 then null else min(p) end as toa_a, case when max(q)<20 then null else min(p)/60.0 end as toa_b,
               (row_no-20)*(row_no-20)+(col_no-20)*(col_no-20) < 144 as observed, 90+(row_no*7+col_no*3)%20 as fuel,
               min(q) as m1, max(q) as m10, sum(q) as m100
        from (select l_suppkey%10 as case_id, l_partkey%40 as row_no, l_orderkey%40 as col_no, l_quantity as q, l_extendedprice as p from {lineitem}) t
        group by case_id, row_no, col_no""",
    "weather_hourly": """
        select user_id%10 as case_id, cast(date_trunc('hour', ts) as {ntz}) as ts, min(value) as temp_c, max(value)/4.0 as rh, min(value)/100.0 as pcp_mm,
               min(value)/2.0 as wind_kph, (min(event_id)*7)%720 as wind_dir_deg, count(*)*30 as cloud_pct
        from {events} group by user_id%10, date_trunc('hour', ts)""",
    "bands": """
        select l_suppkey%10 as case_id, l_linenumber as band, l_partkey%10 as row_no, l_orderkey%10 as col_no, min(l_quantity) as value
        from {lineitem} group by l_suppkey%10, l_linenumber, l_partkey%10, l_orderkey%10""",
    "barrier_segments": """
        select o_orderkey as seg_id, case when o_orderkey%2=0 then 'road' else 'water' end as layer,
               case when o_orderkey%2=0 then case o_orderkey%6 when 0 then 'motorway' when 2 then 'track' else 'path' end
                    else case o_orderkey%6 when 1 then 'river' when 3 then 'ditch' else 'unknown' end end as class,
               (o_orderkey*17)%400 as x1, (o_orderkey*43)%400 as y1, (o_orderkey*17)%400+o_custkey%30 as x2, (o_orderkey*43)%400+o_custkey%20 as y2
        from {orders}""",
    "run_log": """
        select user_id as case_id, row_number() over (partition by user_id order by event_id) as line_no, ts,
               case when event_type='error' and event_id%3=0 then concat('ValueError: no value in line ', cast(event_id as string)) when event_type='error' then 'Traceback (most recent call last)' else concat('=== STEP ', cast(event_id%12+1 as string), ': ', event_type, ' ===') end as text
        from {events}""",
    # A case is a perimeter with the ignition that matches it by name, date and place.
    "case_times": """
        select user_id as case_id, min(ts) as discovery, max(ts) - interval '3' day as fireout, count(*) as acres from {events} group by user_id""",
    # Detections and burns of many fires on one plane, each fire in a square of its own; some burns are missing, empty, elsewhere or without a readable time.
    "spots": """
        select event_id as det_id, user_id, ts as sat_ts, user_id*4000 + (event_id*7919)%3000 as x, (event_id*104729)%3000 as y from {events}""",
    "burns": """
        select user_id as case_id, user_id*4000 + 1500 + (user_id*37)%200 + 0.25 as cx, 1500 + (user_id*53)%200 + 0.5 + case when user_id%13=8 then 9000 else 0 end as cy,
               700 + (user_id%5)*100 as h, user_id%13 as kind,
               case user_id%13 when 6 then null when 7 then '2030-01-01 00:00:00' when 10 then 'unknown' else cast(cast(min(ts) as date) as string) || ' 12:00:00' end as discovery,
               max(ts) - interval '3' day as fireout, count(*) as acres
        from {events} group by user_id""",
}
FIXTURES["perim_edges"] = f"""
    select p.perim_idx, e.edge_no, p.cx+p.h*e.ax as x1, p.cy+p.h*e.ay as y1, p.cx+p.h*e.bx as x2, p.cy+p.h*e.by_ as y2
    from ({FIXTURES["perimeters"]}) p cross join (values (1,1,0,0,1),(2,0,1,-1,0),(3,-1,0,0,-1),(4,0,-1,1,0)) as e(edge_no,ax,ay,bx,by_)"""


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture as a DataFrame over the tables of sf_dir."""
    text = FIXTURES[name]
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if f"{{{t}}}" in text}
    return spark.sql(text.replace("{ntz}", "timestamp_ntz"), **tables)


def fresh(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def with_fixtures(names: list[str], body: str) -> str:
    """DuckDB SQL: the body over fixtures of these names."""
    parts = [f"{n} as ({FIXTURES[n].format(ntz='timestamp', **{t: t for t in TABLES})})" for n in names]
    body = body.strip()
    if body.lower().startswith("with "):
        return f"with {', '.join(parts)}, {body[5:]}"
    return f"with {', '.join(parts)} {body}"
