"""Case tables: selection, names, products, results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config


def display_name(perimeter: Column, point: Column) -> Column:
    return F.coalesce(F.nullif(perimeter, F.lit("")), F.nullif(point, F.lit("")))


def product_years(fires: DataFrame, years: DataFrame, year: str = "year") -> DataFrame:
    """fires with product_year: the latest of `years` (a setting of a few rows, column product_year) not after the fire's, else the earliest."""
    known = years.agg(F.array_sort(F.collect_set("product_year")).alias("__years"))  # one row
    before = F.filter("__years", lambda y: y <= F.col(year))
    return fires.join(F.broadcast(known)).withColumn("product_year", F.coalesce(F.array_max(before), F.array_min("__years"))).drop("__years")


def numeric_cases(names: DataFrame, column: str = "name") -> DataFrame:
    return names.where(F.col(column).rlike("^[0-9]+$"))


def selected(cases: DataFrame, wanted: DataFrame | None = None, done: DataFrame | None = None) -> tuple[DataFrame, DataFrame | None]:
    """(cases, missing): the wanted ones (all if None) without those done; ids that are wanted but not there."""
    missing = None
    if wanted is not None:
        missing = wanted.join(cases, "case_id", "left_anti")
        cases = cases.join(wanted, "case_id", "left_semi")
    return (cases if done is None else cases.join(done, "case_id", "left_anti")), missing


def first_of(candidates: DataFrame, by: str = "case_id", priority: str = "priority") -> DataFrame:
    """Of what exists, the candidate of the smallest priority in each case."""
    return candidates.withColumn("__n", F.row_number().over(Window.partitionBy(by).orderBy(priority))).where("__n = 1").drop("__n")


def newest(files: DataFrame, by: str = "case_id") -> DataFrame:
    """(by, path): the newest file, of equal ones the last by name."""
    return files.groupBy(by).agg(F.max(F.struct("modified", "path")).alias("f")).select(by, F.col("f.path").alias("path"))


def first_lines(rows: DataFrame, most: int, by: str = "case_id", order: str = "line_no") -> DataFrame:
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(by).orderBy(order))).where(F.col("__n") <= most).drop("__n")


def all_results(cases: DataFrame, results: DataFrame) -> DataFrame:
    """Every case with its results, or an error text."""
    joined = cases.join(results.withColumn("__there", F.lit(True)), "case_id", "left")
    return joined.withColumn("error", F.when(F.col("__there").isNull(), "no result")).drop("__there")


def assumed_crs(points: DataFrame, strict: bool = False) -> DataFrame:
    """(case_id, bounds, epsg): 4326 if all of a case's points could be longitudes and latitudes, else null or, if strict, an error when the rows are read. Points without a time do not count."""
    points = points.where("sat_ts is not null") if "sat_ts" in points.columns else points
    ends = points.groupBy("case_id").agg(F.min("x").alias("xmin"), F.max("x").alias("xmax"), F.min("y").alias("ymin"), F.max("y").alias("ymax"))
    fits = (F.col("xmin") >= -180) & (F.col("xmax") <= 180) & (F.col("ymin") >= -90) & (F.col("ymax") <= 90)
    other = F.raise_error(F.format_string("case %s has no CRS and bounds beyond degrees", F.col("case_id").cast("string"))).cast("int") if strict else F.lit(None).cast("int")
    return ends.withColumn("epsg", F.when(fits, 4326).otherwise(other))


def guarded_union(parts: list[DataFrame], key: list[str]) -> DataFrame:
    """All parts, or an error when the rows are read if a key stands in more than one row."""
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p, allowMissingColumns=True)
    n = F.count("*").over(Window.partitionBy(*key))
    return whole.withColumn("__n", F.when(n > 1, F.raise_error(F.concat(F.lit("name collision: "), F.concat_ws(",", *[F.col(k).cast("string") for k in key])))).otherwise(n)).where("__n = 1").drop("__n")


def aliased(df: DataFrame, names: dict[str, tuple[str, ...]]) -> DataFrame:
    """Columns under the first alias that df has, null if it has none: {"x": ("x", "lon", "longitude"), ...}, case ignored."""
    there = {c.lower(): c for c in df.columns}
    found = {k: next((there[a.lower()] for a in options if a.lower() in there), None) for k, options in names.items()}
    return df.select(*[(F.col(c) if c else F.lit(None)).alias(k) for k, c in found.items()])


def scenario_rows(cases: DataFrame, snapped: DataFrame, bands: DataFrame) -> DataFrame:
    """A row for each case to simulate: start cell, stop in seconds, hour of the year, number of weather bands; cases that do not end after their start go."""
    n = bands.groupBy("case_id").agg(F.countDistinct("band").alias("bands"))
    stop = F.timestamp_diff("SECOND", F.col("start_ts"), F.col("end_ts"))
    hour = F.floor(F.timestamp_diff("SECOND", F.date_trunc("year", "start_ts").cast("timestamp_ntz"), F.col("start_ts")) / 3600)
    rows = cases.where("end_ts > start_ts").withColumn("stop_s", stop).withColumn("year", F.year("start_ts").cast("long")).withColumn("hour_of_year", hour)
    return rows.join(snapped, "case_id").join(n, "case_id", "left").select("case_id", "row_no", "col_no", "stop_s", "year", "hour_of_year", F.coalesce("bands", F.lit(0)).alias("bands"))
