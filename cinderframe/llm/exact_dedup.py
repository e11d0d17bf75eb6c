"""Exact duplicates, with frequent texts split off from the shuffle.

A Misra-Gries summary of every partition finds the digests that could hold more than 1 row in COUNTERS. Their exact counts
are verified, the winners are broadcast (COUNTERS rows at most) and settle their rows where these are; all other
digests, none of which can hold more than that share, are shuffled and ranked in a window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .buffers import SPACES
from .tables import durable, read, spare, stored

#: Counters of a summary, and the most rows of the broadcast.
COUNTERS = 1024


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, row_no, n_chars, digest): SHA-256 of each text without white space. Null counts as empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    digest = F.unhex(F.sha2(F.translate(text, SPACES.decode(), ""), 256))
    return docs.select(F.col(id_col), F.length(text).cast("long").alias("n_chars"), digest.alias("digest")).withColumn("row_no", F.monotonically_increasing_id())


def shrink(counts: dict[bytes, int], counters: int) -> dict[bytes, int]:
    """A Misra-Gries summary of at most `counters` keys: the next largest count is taken off all."""
    if len(counts) <= counters:
        return counts
    off = int(np.partition(np.fromiter(counts.values(), np.int64, len(counts)), -counters - 1)[-counters - 1])
    return {k: v - off for k, v in counts.items() if v > off}


def frequent(keys: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """At most `counters` values of a binary column `digest`, among them each that holds over 1/(counters+1) of the rows."""

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}
        for batch in batches:
            for pair in pc.value_counts(batch.column(0)).to_pylist():
                counts[pair["values"]] = counts.get(pair["values"], 0) + pair["counts"]
            counts = shrink(counts, counters)
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["digest", "least"])

    merged = keys.select("digest").mapInArrow(summary, "digest binary, least long").groupBy("digest").agg(F.sum("least").alias("least"))
    return merged.orderBy(F.desc("least"), "digest").limit(counters).select("digest")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """Every row with the row that stays of its group of equal texts.

    Returns id, keep_id, group_size, kept, digest, row_no. Equal: the same after white space is deleted; null text counts as
    empty. The longest original text in code points stays, then the smallest id (a null id last), then one of equal
    rows: of repeated rows exactly one is kept. An empty table gives no rows; other columns are not read.
    """
    rows = durable(digests(docs, id_col, text_col))
    best = F.struct(-F.col("n_chars"), F.col(id_col).isNull(), F.col(id_col), F.col("row_no"))
    candidates = durable(frequent(rows, counters))
    total = rows.count()
    verified = rows.join(F.broadcast(candidates), "digest").groupBy("digest").agg(F.count("*").alias("group_size"), F.min(best).alias("best"))
    winners = durable(verified.where(F.col("group_size") >= max(2, total // counters)).select("digest", "group_size", F.col(f"best.{id_col}").alias("keep_id"), F.col("best.row_no").alias("keep_row")))
    heavy = rows.join(F.broadcast(winners), "digest")
    group = Window.partitionBy("digest")
    order = group.orderBy(F.desc("n_chars"), F.col(id_col).asc_nulls_last(), "row_no")
    light = rows.join(F.broadcast(winners), "digest", "left_anti").withColumn("keep_id", F.first(id_col).over(order)).withColumn("keep_row", F.first("row_no").over(order)).withColumn("group_size", F.count("*").over(group))
    columns = [F.col(id_col), "keep_id", "group_size", (F.col("row_no") == F.col("keep_row")).alias("kept"), "digest", "row_no"]
    return heavy.select(columns).unionByName(light.select(columns))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group of equal texts, with all its columns: the longest original text, then the smallest id, a null id last.

    Null and empty texts are one group. Of rows that repeat an id and a text one stays; rows that share an id and differ in text are told apart. An empty
    table gives no rows.
    """
    groups = durable(exact_groups(docs, id_col, text_col))
    # What goes is the lesser part; stored, so that Spark knows its size and need not shuffle the texts for it.
    gone, _ = stored(groups.where("not kept").select(F.col(id_col).alias("__id")).distinct())
    again = durable(groups.groupBy(id_col).agg(F.count("*").alias("n")).where("n > 1").select(F.col(id_col).alias("__again")))
    if again.isEmpty():
        return docs.join(gone, docs[id_col].eqNullSafe(gone["__id"]), "left_anti")
    # Ids that repeat: their rows, few in any corpus with a key, are told apart by text as well.
    same = docs[id_col].eqNullSafe(again["__again"])
    plain = docs.join(again, same, "left_anti")
    digest, rank = spare(docs, "__digest"), spare(docs, "__rank")
    text = F.coalesce(F.col(text_col), F.lit(""))
    twice = docs.join(again, same, "left_semi").withColumn(digest, F.sha2(F.translate(text, SPACES.decode(), ""), 256))
    order = Window.partitionBy(id_col, digest).orderBy(F.desc(F.length(text)))
    twice = twice.withColumn(rank, F.row_number().over(order)).where(F.col(rank) == 1).drop(rank)
    want = groups.where("kept").select(F.col(id_col).alias("__id"), F.lower(F.hex("digest")).alias("__want"))
    twice = twice.join(want, twice[id_col].eqNullSafe(want["__id"]) & (twice[digest] == want["__want"]), "left_semi").drop(digest)
    return plain.join(gone, plain[id_col].eqNullSafe(gone["__id"]), "left_anti").unionByName(twice)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_groups(read(spark, sf_dir, "documents"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


ORACLE = r"""
with d as (
  select doc_id, length(coalesce(text, '')) as n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as text_sha256
  from documents
)
select doc_id,
  first_value(doc_id) over (partition by text_sha256 order by n desc, doc_id) as keep_id,
  count(*) over (partition by text_sha256) as group_size,
  row_number() over (partition by text_sha256 order by n desc, doc_id) = 1 as kept,
  text_sha256
from d
"""
