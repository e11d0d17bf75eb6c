"""The folder that driver and executors share, and tables that are computed once."""

from __future__ import annotations

import gc
import tempfile

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or the folder that the session has been given. Without either a session on one machine gets one of its own, as in tests; a cluster is an error."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return sc.getCheckpointDir()


def once(df: DataFrame) -> DataFrame:
    """df, computed once and kept in the shared folder: for tables that a plan reads more than once."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def let_go(spark: SparkSession) -> None:
    """Has the driver collect its garbage: only then does Spark remove the shuffle files of steps that nothing refers to."""
    for _ in range(2):  # what Python lets go reaches the JVM with the next call
        gc.collect()
        spark.sparkContext._jvm.System.gc()


def numbered(df: DataFrame, *keys: str, to: str = "nth") -> DataFrame:
    """df with `to`, its place from 1 in order of unique keys: ranges are sorted and counted each for itself, so no task holds all rows."""
    placed = once(df.select(*keys).repartitionByRange(*keys).withColumn("__part", F.spark_partition_id()))
    counts = placed.groupBy("__part").agg(F.count("*").alias("__n"))
    ahead = counts.select("__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__ahead"))  # a row for each range
    nth = placed.withColumn("__in", F.row_number().over(Window.partitionBy("__part").orderBy(*keys))).join(ahead, "__part")
    return df.join(nth.select(*keys, (F.col("__in") + F.col("__ahead")).cast("long").alias(to)), list(keys))


def numbered_within(df: DataFrame, by: list[str], *keys: str, to: str = "nth", weight: str | None = None) -> DataFrame:
    """df with `to`, each row's place from 1 within its group in order of `keys`, by sorted ranges of all rows, so that a large group is not one task's.

    With `weight` a row counts so many times, and `to` is the place of its last one. Only the rows of each range and group are summed over all ranges.
    """
    placed = once(df.repartitionByRange(*by, *keys).withColumn("__part", F.spark_partition_id()))
    each = F.lit(1) if weight is None else F.col(weight)
    counts = placed.groupBy(*by, "__part").agg(F.sum(each).alias("__n"))
    ahead = counts.select(*by, "__part", (F.sum("__n").over(Window.partitionBy(*by).orderBy("__part")) - F.col("__n")).alias("__ahead"))  # a row for each group in a range
    inside = Window.partitionBy(*by, "__part").orderBy(*keys).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = placed.withColumn("__in", F.sum(each).over(inside)).join(ahead.withColumnsRenamed({k: f"__{k}" for k in by} | {"__part": "__of"}), [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in by] + [F.col("__part") == F.col("__of")])
    return met.withColumn(to, (F.col("__in") + F.col("__ahead")).cast("long")).drop("__part", "__of", "__in", "__ahead", *[f"__{k}" for k in by])


def medians(df: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """(by, column, median) of each column that has a value: exact, the mean of the middle two; NaN is the largest value.

    Equal values are counted before they are sorted, and only a range's rows are in one task.
    """
    long = df.unpivot(by, [F.col(c).cast("double").alias(c) for c in columns], "column", "__value").where("__value is not null")
    counts = long.groupBy(*by, "column", "__value").agg(F.count("*").alias("__count"))
    upto = numbered_within(counts, [*by, "column"], "__value", to="__upto", weight="__count")
    n = counts.groupBy(*by, "column").agg(F.sum("__count").alias("__all")).withColumnsRenamed({k: f"__{k}" for k in (*by, "column")})
    met = upto.join(n, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in (*by, "column")])
    has = lambda k: (F.col("__upto") >= k) & (F.col("__upto") - F.col("__count") < k)
    low, high = has(F.floor((F.col("__all") + 1) / 2)), has(F.floor(F.col("__all") / 2) + 1)
    middle = met.where(low | high).groupBy(*by, "column").agg(F.max(F.when(low, F.col("__value"))).alias("a"), F.max(F.when(high, F.col("__value"))).alias("b"))
    return middle.select(*by, "column", (0.5 * F.col("a") + 0.5 * F.col("b")).alias("median"))
