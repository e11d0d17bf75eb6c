"""Files in and out of tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..folders import once
from ..functions.text import iso
from ..operators.dating import with_hotspot_time
from ..operators.grids import centre_of


def read_cases(spark: SparkSession, path: str) -> DataFrame:
    """The master CSV, its satellite columns as null where the file lacks them."""
    head = spark.read.option("header", True).csv(path).columns
    known = {f.name: f for f in S.CASES} | {k: T.StructField(k, T.TimestampNTZType()) for k in S.SATELLITE_TIMES}
    fields = T.StructType([known.get(c, T.StructField(c, T.StringType())) for c in head])
    df = spark.read.schema(fields).option("header", True).csv(path)
    S.require_columns(df, "folder")
    return df.withColumns({k: F.lit(None).cast("timestamp_ntz") for k in S.SATELLITE_TIMES if k not in head})


def write_cases(cases: DataFrame, path: str) -> None:
    cases.orderBy("folder").write.mode("overwrite").option("header", True).csv(path)


def metadata_json(cases: DataFrame, key: str = "case_id") -> DataFrame:
    """(key, json): a document for each case, keys sorted, times as ISO text, nulls kept."""
    columns = sorted(c for c in cases.columns if c != key)
    times = {f.name for f in cases.schema if isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType))}
    return cases.select(key, F.to_json(F.struct(*[(iso(F.col(c)) if c in times else F.col(c)).alias(c) for c in columns]), {"ignoreNullFields": "false"}).alias("json"))


def from_metadata_json(docs: DataFrame, fields: str, key: str = "case_id") -> DataFrame:
    """Columns of a DDL schema from (key, json); `folder` is the key where the document has none."""
    got = docs.select(key, F.from_json("json", fields).alias("d")).select(key, "d.*")
    return got.withColumn("folder", F.coalesce("folder", F.col(key).cast("string"))) if "folder" in got.columns else got


def write_metadata(cases: DataFrame, existing: DataFrame, path: str, key: str = "case_id") -> None:
    """A JSON file folder per case that exists."""
    metadata_json(cases.join(existing, key, "left_semi"), key).write.mode("overwrite").partitionBy(key).text(path)


def safe_for_files(df: DataFrame, geometry: str = "rings") -> DataFrame:
    """Rows with a geometry, times without zone, and no nested column beside the geometry."""
    nested = [f.name for f in df.schema if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) and f.name != geometry]
    zoned = {f.name: F.col(f.name).cast("timestamp_ntz") for f in df.schema if isinstance(f.dataType, T.TimestampType)}
    return df.where(F.size(geometry) > 0).drop(*nested).withColumns(zoned)


def read_fires(spark: SparkSession, path: str, schema: T.StructType, *required: str, form: str = "parquet", stream: bool = False) -> DataFrame:
    """A table of perimeters, ignitions or hotspots with the columns and types of `schema`, as a batch or a stream.

    An error names `required` columns that the source lacks; others that it lacks are null, and columns beside the schema's stay out.
    """
    there = spark.read.option("header", True).format(form).load(path)
    S.require_columns(there, *required)
    reader = spark.readStream.schema(there.schema) if stream else spark.read.schema(there.schema)
    rows = reader.option("header", True).format(form).load(path)
    return rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def read_perimeters(spark: SparkSession, path: str, form: str = "parquet", stream: bool = False) -> DataFrame:
    return read_fires(spark, path, S.PERIMETERS, "perim_name", "ig_date", "acres", form=form, stream=stream)


def read_ignitions(spark: SparkSession, path: str, form: str = "parquet", stream: bool = False) -> DataFrame:
    return read_fires(spark, path, S.IGNITIONS, "point_name", "discovery", "fireout", form=form, stream=stream)


def read_hotspots(spark: SparkSession, path: str, form: str = "parquet", stream: bool = False) -> DataFrame:
    """Hotspots with sat_ts from their date and HHMM columns; those without a time go."""
    return with_hotspot_time(read_fires(spark, path, S.HOTSPOTS, "acq_date", "acq_time", form=form, stream=stream))


def write_by_case(df: DataFrame, path: str, key: str = "case_id", order: tuple[str, ...] = (), add: bool = False) -> None:
    """A folder of files for each case, beside those that are there if `add`. Rows are in the order of these columns, which makes files of places and numbers that repeat or grow far smaller."""
    rows = df.repartition(key).sortWithinPartitions(key, *order)
    packed = {"compression": "zstd", "parquet.writer.version": "PARQUET_2_0"}  # whole numbers as differences
    rows.write.mode("append" if add else "overwrite").options(**packed).partitionBy(key).parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """(case_id, line_no, text) of text files in folders named by case (all *.txt under a folder, or those of a pattern), read by lines; a large file is split among tasks.

    Lines are numbered by the place of their split in the file and their place in the split; a file that ends in a line break has no last empty line.
    """
    name = F.col("_metadata.file_path")
    # A folder of very many cases is listed by tasks, which a pattern is not.
    files = spark.read.text(path) if "*" in path else spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").text(path)
    rows = files.select(name.alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("nth"), F.regexp_replace("value", "\r$", "").alias("text"))
    order = Window.partitionBy("file").orderBy("block", "nth")
    return once(rows).select(F.regexp_extract("file", r"/([^/]+)/[^/]+$", 1).alias("case_id"), F.row_number().over(order).cast("long").alias("line_no"), "text")


def files_of(spark: SparkSession, path: str) -> DataFrame:
    """(case_id, path, modified) of files in folders named by case."""
    return spark.read.format("binaryFile").load(path).select(F.regexp_extract("path", r"/([^/]+)/[^/]+$", 1).alias("case_id"), "path", F.col("modificationTime").alias("modified"))


#: What a file must hold: a weather file its header and a line of ten fields, a grid file its size.
WEATHER_FILE = (r"(?m)^\s*Year.*WindSpd", r"(?m)^\s*\d+(?:[ \t]+\S+){9,}\s*$")
GRID_FILE = (r"(?im)^\s*ncols\s+\d", r"(?im)^\s*nrows\s+\d", r"(?im)^\s*cellsize\s+\S")


def write_lines_by_case(lines: DataFrame, path: str) -> None:
    """A text file for each case, in a folder of its own, from (case_id, line_no, line)."""
    whole = lines.groupBy("case_id").agg(F.array_join(F.sort_array(F.collect_list(F.struct("line_no", "line")))["line"], "\n").alias("value"))
    whole.write.partitionBy("case_id").text(path)


def file_lines(spark: SparkSession, path: str, pattern: str, needs: tuple[str, ...]) -> DataFrame:
    """(case_id, path, line_no, line) of all files of a name pattern under path, wherever Spark can read; a file's case is the number of its folder. A file without what it needs is an error that names it, when rows are read."""
    whole = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    there = F.lit(True)
    for need in needs:
        there = there & F.col("value").rlike(need)
    value = F.when(there, F.col("value")).otherwise(F.raise_error(F.concat(F.lit("no header or no rows in "), F.col("path"))).cast("string"))
    case = F.regexp_extract("path", r"(\d+)/[^/]*$", 1).try_cast("long")
    lines = whole.select(case.alias("case_id"), "path", F.posexplode(F.split(value, r"\r?\n")).alias("line_no", "line"))
    return lines.withColumn("line_no", F.col("line_no") + 1)


HEADER = ("ncols", "nrows", "xllcorner", "yllcorner", "cellsize", "nodata_value")


def grid_text(cells: DataFrame, grids: DataFrame) -> DataFrame:
    """(case_id, line_no, line): an ESRI ASCII grid from cells on grids(case_id, ncols, nrows, xll, yll, cellsize); negatives become 0, absent cells -9999."""
    head = grids.select("case_id", F.posexplode(F.array(
        F.format_string("ncols %d", "ncols"), F.format_string("nrows %d", "nrows"), F.format_string("xllcorner %.6f", "xll"), F.format_string("yllcorner %.6f", "yll"), F.format_string("cellsize %.6f", "cellsize"), F.lit("NODATA_value -9999"),
    )).alias("line_no", "line"))
    every = grids.withColumn("row_no", F.explode(F.expr("sequence(0, int(nrows) - 1)"))).withColumn("col_no", F.explode(F.expr("sequence(0, int(ncols) - 1)"))).select("case_id", "row_no", "col_no")
    values = every.join(cells.select("case_id", F.col("row_no").cast("int").alias("row_no"), F.col("col_no").cast("int").alias("col_no"), "value"), ["case_id", "row_no", "col_no"], "left")
    shown = F.when(F.col("value").isNull(), F.lit("-9999")).otherwise(F.format_string("%.4f", F.greatest(F.col("value").cast("double"), F.lit(0.0))))
    rows = values.groupBy("case_id", "row_no").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("col_no", shown.alias("s")))), lambda c: c.s), " ").alias("line"))
    return head.unionByName(rows.select("case_id", (F.col("row_no") + 6).alias("line_no"), "line"))


def grid_header(lines: DataFrame) -> DataFrame:
    """(case_id, ncols, nrows, xll, yll, cellsize, xmax, ymax) from the header lines of a grid text, names in any case."""
    part = F.split(F.trim("line"), r"\s+")
    pairs = lines.withColumn("p", part).where("size(p) = 2").withColumn("k", F.lower(F.col("p")[0])).where(F.col("k").isin(*HEADER))
    wide = pairs.groupBy("case_id").pivot("k", list(HEADER)).agg(F.first(F.col("p")[1].try_cast("double")))
    wide = wide.select("case_id", F.col("ncols").cast("long").alias("ncols"), F.col("nrows").cast("long").alias("nrows"), F.col("xllcorner").alias("xll"), F.col("yllcorner").alias("yll"), "cellsize", F.col("nodata_value").alias("nodata"))
    return wide.withColumn("xmax", F.col("xll") + F.col("ncols") * F.col("cellsize")).withColumn("ymax", F.col("yll") + F.col("nrows") * F.col("cellsize"))


def grid_cells(lines: DataFrame) -> DataFrame:
    """(case_id, row_no, col_no, x, y, value) of a grid text, nodata as null."""
    heads = grid_header(lines)
    part = F.split(F.trim("line"), r"\s+")
    is_head = F.lower(part[0]).isin(*HEADER)
    first = lines.where(~is_head).groupBy("case_id").agg(F.min("line_no").alias("first"))
    rows = lines.where(~is_head & (F.trim("line") != "")).join(first, "case_id").select("case_id", (F.col("line_no") - F.col("first")).alias("row_no"), F.posexplode(part).alias("col_no", "s"))
    joined = rows.join(heads, "case_id")
    x, y = centre_of(F.col("row_no"), F.col("col_no"), F.col("xll"), F.col("ymax"), F.col("cellsize"))
    value = F.col("s").try_cast("double")
    return joined.select("case_id", F.col("row_no").cast("long").alias("row_no"), F.col("col_no").cast("long").alias("col_no"), x.alias("x"), y.alias("y"), F.when(value != F.coalesce("nodata", F.lit(-9999.0)), value).alias("value"))

