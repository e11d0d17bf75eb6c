"""Hourly weather: rounding, windows, means, burn periods, and the text form."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config

#: Edges of a weather window by use: what is added to start and end, and whether they go down to the hour.
MODES = {"sink": (0, 1, True), "wxs": (0, 0, True), "model": (-1, 1, True), "legacy": (0, 0, False)}


def whole(v: Column) -> Column:
    """Nearest whole number, halves to even."""
    return F.bround(v).cast("long")


def rounded(weather: DataFrame) -> DataFrame:
    """The values as the text form holds them: whole numbers in their ranges, rain as it is."""
    clamp = lambda c, lo, hi: F.greatest(F.lit(lo), F.least(F.lit(hi), whole(F.col(c)))).cast("long")
    return weather.select("case_id", "ts", whole(F.col("temp_c")).alias("temp_c"), clamp("rh", 0, 99).alias("rh"), "pcp_mm", whole(F.col("wind_kph")).alias("wind_kph"), F.pmod(whole(F.col("wind_dir_deg")), F.lit(360)).cast("long").alias("wind_dir_deg"), clamp("cloud_pct", 0, 100).alias("cloud_pct"))


def hour(ts: Column) -> Column:
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def hours(n: int) -> Column:
    return F.expr(f"interval {n} hours")


def in_window(weather: DataFrame, windows: DataFrame, mode: str = "wxs") -> DataFrame:
    """Weather of each case (case_id, start_ts, end_ts) within its window, with the edges of `mode`, ends included."""
    before, after, down = MODES[mode]
    lo, hi = F.col("start_ts") + hours(before), F.col("end_ts") + hours(after)
    if down:
        lo, hi = hour(lo), hour(hi)
    return weather.join(windows.select("case_id", lo.alias("__lo"), hi.alias("__hi")), "case_id").where(F.col("ts").between(F.col("__lo"), F.col("__hi"))).drop("__lo", "__hi")


def mean_wind(weather: DataFrame, windows: DataFrame) -> DataFrame:
    """(case_id, wind_kph): mean over the fire's window, over the whole series if the window is unknown or empty."""
    w = windows.select("case_id", hour(F.col("start_ts")).alias("lo"), hour(F.col("end_ts") + hours(1)).alias("hi"))
    rows = weather.join(w, "case_id", "left")
    inside = F.col("ts").between(F.col("lo"), F.col("hi"))
    return rows.groupBy("case_id").agg(F.coalesce(F.avg(F.when(inside, F.col("wind_kph"))), F.avg("wind_kph")).alias("wind_kph"))


def from_model(df: DataFrame) -> DataFrame:
    """Kelvin, wind components in m/s and a cloud share as degrees Celsius, speed in km/h, direction it comes from, and percent."""
    direction = F.pmod(270 - F.degrees(F.atan2("v_ms", "u_ms")), F.lit(360.0))
    return df.withColumns({"temp_c": F.col("temp_k") - 273.15, "wind_kph": F.hypot("u_ms", "v_ms") * 3.6, "wind_dir_deg": direction, "cloud_pct": F.when(F.col("cloud") <= 1.5, F.col("cloud") * 100).otherwise(F.col("cloud"))})


def burn_periods(fires: DataFrame) -> DataFrame:
    """(case_id, month, day, from, to): a row for each calendar day from start to end, clipped on the first and last."""
    days = fires.withColumn("date", F.explode(F.sequence(F.to_date("start_ts"), F.to_date("end_ts"))))
    clock = lambda c: F.date_format(c, "HHmm")
    begin = F.when(F.col("date") == F.to_date("start_ts"), clock("start_ts")).otherwise("0000")
    end = F.when(F.col("date") == F.to_date("end_ts"), clock("end_ts")).otherwise("2359")
    return days.select("case_id", F.month("date").cast("long").alias("month"), F.dayofmonth("date").cast("long").alias("day"), begin.alias("from"), end.alias("to"))


def split_windows(fires: DataFrame, days: int = config.WINDOW_DAYS) -> DataFrame:
    """(case_id, from_ts, to_ts): consecutive windows of at most `days` from start to end; neighbours share their edge."""
    at = F.explode(F.sequence(F.col("start_ts"), F.col("end_ts"), F.expr(f"interval {days} days")))
    return fires.withColumn("from_ts", at).where("from_ts < end_ts").select("case_id", "from_ts", F.least(F.col("from_ts") + F.expr(f"interval {days} days"), F.col("end_ts")).alias("to_ts"))


def wind_schedule(fires: DataFrame, bands: DataFrame) -> DataFrame:
    """(case_id, band, month, day, hhmm): the hour of each band from the fire's start, until its end."""
    rows = bands.select("case_id", "band").distinct().join(fires, "case_id").withColumn("ts", F.col("start_ts") + F.make_dt_interval(F.lit(0), F.col("band") - 1)).where("ts <= end_ts")
    return rows.select("case_id", "band", F.month("ts").cast("long").alias("month"), F.dayofmonth("ts").cast("long").alias("day"), F.date_format("ts", "HHmm").alias("hhmm"))


def request_windows(fires: DataFrame, dem: DataFrame, days: int = config.CONDITIONING_DAYS) -> tuple[DataFrame, DataFrame]:
    """((case_id, from_ts, to_ts, row_no, col_no, elevation), rejected): the weather each fire needs, at the middle cell of its grid, row and column half their number rounded down,
    or the cell with a value that is nearest to it; fires without times or grid are rejected. with_places() adds where that is.
    """
    size = dem.groupBy("case_id").agg(F.floor((F.max("row_no") + 1) / 2).alias("r2"), F.floor((F.max("col_no") + 1) / 2).alias("c2"))
    off = F.greatest(F.abs(F.col("row_no") - F.col("r2")), F.abs(F.col("col_no") - F.col("c2")))
    centre = dem.join(size, "case_id").groupBy("case_id").agg(F.min(F.struct(off.alias("off"), "row_no", "col_no", "value")).alias("p")).select("case_id", F.col("p.row_no").alias("row_no"), F.col("p.col_no").alias("col_no"), F.col("p.value").alias("elevation"))
    good = fires.where("start_ts is not null and end_ts is not null").join(centre, "case_id")
    out = good.select("case_id", (F.col("start_ts") - F.expr(f"interval {days} days")).alias("from_ts"), F.col("end_ts").alias("to_ts"), "row_no", "col_no", "elevation")
    return out, fires.join(out, "case_id", "left_anti")


def after_conditioning(weather: DataFrame, days: int = config.CONDITIONING_DAYS) -> DataFrame:
    """Rows of each case after its first `days` of hourly records, with their number from 1."""
    n = F.row_number().over(Window.partitionBy("case_id").orderBy("ts"))
    return weather.withColumn("nth", n - 24 * days).where("nth > 0")


def first_and_last(weather: DataFrame) -> DataFrame:
    return weather.groupBy("case_id").agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


def whole_rain(weather: DataFrame) -> DataFrame:
    return weather.withColumn("pcp_mm", whole(F.col("pcp_mm")))


# The lines above the hours in the text form.
HEAD_LINES = ("RAWS_UNITS: METRIC", "RAWS_WINDS: OpenMeteo_ERA5_center_of_DEM", "Year Mth Day Time Temp RH HrlyPcp WindSpd WindDir CloudCov")


def text_lines(weather: DataFrame, elevation: DataFrame) -> DataFrame:
    """(case_id, line_no, line): four header lines and a line of fixed width for each hour. `elevation` has case_id and elevation."""
    head = elevation.select("case_id", F.posexplode(F.array(
        F.format_string("RAWS_ELEVATION: %d", whole(F.col("elevation"))), *map(F.lit, HEAD_LINES),
    )).alias("line_no", "line")).withColumn("line_no", F.col("line_no") + 1)
    number = F.row_number().over(Window.partitionBy("case_id").orderBy("ts")) + 4
    time = F.hour("ts") * 100 + F.minute("ts")
    line = F.format_string("%4d %2d %2d %04d %4d %3d %7.3f %3d %3d %3d", F.year("ts"), F.month("ts"), F.dayofmonth("ts"), time, "temp_c", "rh", F.col("pcp_mm").cast("double"), "wind_kph", "wind_dir_deg", "cloud_pct")
    return head.unionByName(rounded(weather).select("case_id", number.alias("line_no"), line.alias("line")))


def from_text(lines: DataFrame) -> DataFrame:
    """Weather from (case_id, line_no, line): rows of ten fields or more below the first line that starts with Year and names WindSpd."""
    is_head = F.trim("line").startswith("Year") & F.col("line").contains("WindSpd")
    heads = lines.where(is_head).groupBy("case_id").agg(F.min("line_no").alias("head"))
    part = F.split(F.trim("line"), r"\s+")
    rows = lines.join(heads, "case_id").where("line_no > head").withColumn("p", part).where("size(p) >= 10")
    clock = F.lpad(F.col("p")[3], 4, "0")
    ts = F.make_timestamp_ntz(F.col("p")[0].cast("int"), F.col("p")[1].cast("int"), F.col("p")[2].cast("int"), F.substring(clock, 1, 2).cast("int"), F.substring(clock, 3, 2).cast("int"), F.lit(0))
    names = ("temp_c", "rh", "pcp_mm", "wind_kph", "wind_dir_deg", "cloud_pct")
    return rows.select("case_id", ts.alias("ts"), *[F.col("p")[4 + i].cast("double").alias(k) for i, k in enumerate(names)])


