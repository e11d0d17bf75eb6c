"""Connected components of a table of links, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import durable


#: Links that a task takes at least: a small table of links is not dealt to more tasks than that needs, as each of many rounds has several steps.
LINKS_OF_TASK = 2**16


def components(links: DataFrame, rounds: int = 100) -> DataFrame:
    """(node, root): the smallest node that each end of a link reaches. `links` has columns a and b of one ordered type.

    Alternates two star steps: a node hands its larger neighbours to its smallest one, then its smaller ones. The
    number of rounds grows with the logarithm of a component's size; each round is cut by a checkpoint, in tasks by the number of links. Nulls link nothing.
    """
    edges = durable(links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    tasks = edges.count() // LINKS_OF_TASK + 1
    few = lambda df: df.coalesce(tasks)  # noqa: E731  never more than there are
    for _ in range(rounds):
        edges = few(edges)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        handed = few(both.join(least.hint("merge"), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v"))
        large = few(handed.distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        pairs = few(large.join(least.hint("merge"), "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        edges = durable(few(pairs.unionByName(few(least.select("u", F.col("m").alias("v")))).distinct()))
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now
    raise RuntimeError(f"components did not settle in {rounds} rounds")
