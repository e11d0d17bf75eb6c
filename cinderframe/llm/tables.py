"""Inputs and cut points that the corpus operators share."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..folders import shared_folder


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def durable(df: DataFrame) -> DataFrame:
    """df, computed once and kept in the shared folder, which outlives any executor."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> tuple[DataFrame, str]:
    """(df, path): df written once as a compressed table in the shared folder; release() drops it."""
    path = f"{shared_folder(df.sparkSession)}/step-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def release(spark: SparkSession, *paths: str) -> None:
    """Drops stored tables, and has the driver collect its garbage: only then does Spark remove the shuffle files of steps that nothing refers to."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    for _ in range(2):  # what Python lets go reaches the JVM with the next call
        gc.collect()
        spark._jvm.System.gc()


def spare(df: DataFrame, name: str) -> str:
    """`name`, lengthened until df has no column of it."""
    while name in df.columns:
        name += "_"
    return name


def fold(column: str, folds: int):
    """crc32 of an id as text, modulo folds; a null id falls into fold -1."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % folds, F.lit(-1)).cast("int")
