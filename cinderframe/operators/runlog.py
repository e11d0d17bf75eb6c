"""State of runs from their log lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config

# What the log format says. A step begins with "=== STEP <number>: <label>", a crash with a traceback, a finished run with a last line.
STEP = r"=== STEP (\d+):\s*(\S+)"
TRACEBACK, COMPLETED = "Traceback (most recent call last)", "CASE COMPLETED."
LAST_STEP = 12
#: The line that ends a traceback begins with the name of an exception, and a colon, bracket or space after it.
ERROR_LINE = r"^\s*[A-Za-z_]*(?:Error|Exception)(?=[:\s])"


def step_number(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, STEP, 1), F.lit("")).cast("long")


def case_state(log: DataFrame, cases: DataFrame | None = None, outputs: DataFrame | None = None, tail: int = 60, end: int = 10) -> DataFrame:
    """(case_id, status, step, label, error) of the cases that have a log, or of all `cases` (case_id).

    In this order: a case in `outputs` (case_id) is done; without a log it is pending; completed in the last `end` lines is done; no step yet is
    starting; a traceback in the last `tail` lines is failed; else running. What is done is at the last step.
    """
    back = F.row_number().over(Window.partitionBy("case_id").orderBy(F.desc("line_no")))
    rows = log.withColumn("back", back).withColumn("step", step_number(F.col("text")))
    stepped, erred = F.col("step").isNotNull(), (F.col("back") <= tail) & F.col("text").rlike(ERROR_LINE)
    got = rows.groupBy("case_id").agg(
        F.max_by(F.when(stepped, F.struct("step", F.regexp_extract("text", STEP, 2).alias("label"))), F.when(stepped, F.col("line_no"))).alias("at"),
        F.bool_or((F.col("back") <= end) & F.col("text").contains(COMPLETED)).alias("done"),
        F.bool_or((F.col("back") <= tail) & F.col("text").contains(TRACEBACK)).alias("failed"),
        F.min_by(F.when(erred, F.trim("text")), F.when(erred, F.col("back"))).alias("error"),
        F.lit(True).alias("logged"),
    )
    got = got if cases is None else cases.select("case_id").distinct().join(got, "case_id", "left")
    there = F.lit(False)
    if outputs is not None:
        got, there = got.join(outputs.select("case_id", F.lit(True).alias("there")).distinct(), "case_id", "left"), F.coalesce("there", F.lit(False))
    status = F.when(there, "done").when(F.col("logged").isNull(), "pending").when(F.col("done"), "done").when(F.col("at.step").isNull(), "starting").when(F.col("failed"), "failed").otherwise("running")
    step = F.when(status == "done", F.lit(LAST_STEP).cast("long")).otherwise(F.col("at.step"))
    return got.select("case_id", status.alias("status"), step.alias("step"), F.when(status != "pending", F.col("at.label")).alias("label"), F.when(status == "failed", F.substring("error", 1, 52)).alias("error"))


def status_rank(status: Column) -> Column:
    order = F.create_map(*[F.lit(x) for i, s in enumerate(config.STATUS_ORDER) for x in (s, i)])
    return F.element_at(order, status)


def elapsed(log: DataFrame, until: Column | None = None) -> DataFrame:
    """(case_id, elapsed_s): from the first line's time to the last's (or `until`); a clock that ran past midnight gains a day."""
    ends = log.groupBy("case_id").agg(F.min_by("ts", "line_no").alias("first_ts"), F.max_by("ts", "line_no").alias("last_ts"))
    s = F.timestamp_diff("SECOND", F.col("first_ts"), F.col("last_ts") if until is None else until)
    return ends.select("case_id", F.when(s < 0, s + 86400).otherwise(s).alias("elapsed_s"))


def _settings(text: Column) -> Column:
    """(k, v) of each `key = number` of a line: the word before each equals sign, and the word after it if that is a number."""
    parts = F.split(text, "=")
    word = lambda p, place: F.element_at(F.split(F.trim(p), r"\s+"), place)
    number = lambda p: F.when(word(p, 1).rlike("^[0-9]"), F.rtrim(word(p, 1), F.lit(",;")).try_cast("double"))
    rest = F.size(parts) - 1
    pairs = F.zip_with(F.slice(parts, 1, rest), F.slice(parts, 2, rest), lambda a, b: F.struct(word(a, -1).alias("k"), number(b).alias("v")))
    return F.filter(pairs, lambda p: (p.k != "") & p.v.isNotNull())


def _runtime(text: Column) -> Column:
    """Seconds of a line `Runtime : n s`."""
    after = F.split(F.substring_index(F.lower(text), "runtime", -1), ":", 2)
    number = F.rtrim(F.element_at(F.split(F.trim(F.get(after, F.lit(1))), r"\s+"), 1), F.lit("s"))
    return F.when(F.lower(text).contains("runtime") & (F.trim(after[0]) == ""), number.try_cast("double"))


def key_values(log: DataFrame, most: int = 120) -> DataFrame:
    """(case_id, key, value): the first value of each of the first `most` key = number pairs, and Runtime_s from a line `Runtime : n s`."""
    found = log.select("case_id", "line_no", F.posexplode(_settings(F.col("text"))).alias("i", "kv"))
    order = Window.partitionBy("case_id").orderBy("line_no", "i")
    pairs = found.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= most).groupBy("case_id", F.col("kv.k").alias("key")).agg(F.min_by("kv.v", "nth").alias("value"))
    runs = log.withColumn("r", _runtime(F.col("text"))).where("r is not null").groupBy("case_id").agg(F.min_by("r", "line_no").alias("value")).select("case_id", F.lit("Runtime_s").alias("key"), "value")
    return pairs.unionByName(runs.join(pairs.where("key = 'Runtime_s'"), "case_id", "left_anti"))


def last_csv_row(lines: DataFrame) -> DataFrame:
    """(case_id, key, value): the last row of each case's CSV file, from its lines (case_id, line_no, text), by the names in the first; blank lines do not count."""
    rows = lines.where(F.trim("text") != "")
    ends = rows.groupBy("case_id").agg(F.min_by("text", "line_no").alias("head"), F.max_by("text", "line_no").alias("last"), F.count("*").alias("n")).where("n > 1")
    cut = lambda c: F.transform(F.split(F.col(c), ","), lambda v: F.trim(v))
    return ends.select("case_id", F.explode(F.arrays_zip(cut("head").alias("key"), cut("last").alias("value"))).alias("p")).select("case_id", "p.key", "p.value").where("key is not null")


def stop_hours(text: Column) -> Column:
    """Hours of a setting SIMULATION_TSTOP = seconds."""
    return F.nullif(F.regexp_extract(text, r"SIMULATION_TSTOP\s*=\s*([0-9.]+)", 1), F.lit("")).cast("double") / 3600
