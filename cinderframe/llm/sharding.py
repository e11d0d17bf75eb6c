"""Shards of near equal bytes by sampled splitters.

Equal texts form a group, which is never split. The groups are ordered by a hash of their text. A sample of them, drawn with a chance in
proportion to size, gives quantile boundaries that cut the order into many ranges; the bytes of each range are counted, and overfull ones are
subdivided by a further sample until no range of several groups is overfull. Inside a range a running sum places each group among all bytes, and
its middle names its shard. A group that is larger than an even share gets a shard of its own, and the others share what is left.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import durable, read

#: Ranges per shard at least, bytes of a range at most, and rows of the sample per range. The driver holds a row for each range and the sample.
RANGES, RANGE_BYTES, DRAWS = 64, 1 << 30, 16


def _sample(groups: DataFrame, total: int, n: int, salt: int) -> np.ndarray:
    """About n groups' h, sorted, drawn with a chance in proportion to size: those whose exponential arrival time comes before n / total."""
    u = (F.pmod(F.xxhash64("h", F.lit(salt)), F.lit(1 << 52)) + 1) / float((1 << 52) + 1)
    return np.sort(np.array([r[0] for r in groups.where(-F.log(u) / F.col("bytes") < n / max(1, total)).select("h").collect()], np.int64))


def _ranged(groups: DataFrame, cuts: np.ndarray) -> DataFrame:
    """groups with `range`: how many cuts are at or below the group's hash."""

    @F.pandas_udf("int")
    def place(h: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, h.to_numpy(), "right").astype(np.int32))

    return groups.withColumn("range", place("h"))


def splitters(groups: DataFrame, total: int, ranges: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """(cuts, [(range, groups' rows, bytes)] in order) such that no range of more than one group holds over twice its share of all bytes."""
    draw, salt = _sample(groups, total, ranges * DRAWS, 0), 0
    cuts = np.unique(draw[DRAWS::DRAWS])
    while True:
        sizes = _ranged(groups, cuts).groupBy("range").agg(F.sum("rows"), F.sum("bytes"), F.min("h"), F.max("h")).orderBy("range").collect()
        over = [r for r in sizes if r[3] < r[4] and r[2] > 2 * total / ranges]
        if not over:
            return cuts, [(r[0], r[1], r[2]) for r in sizes]
        salt += 1
        parts = {r[0]: 1 + int(r[2] * ranges / total) for r in over}
        inside = _ranged(groups, cuts).where(F.col("range").isin(list(parts)))
        draw = _sample(inside, sum(r[2] for r in over), DRAWS * sum(parts.values()), salt)
        where, more = np.searchsorted(cuts, draw, "right"), []
        for r in over:
            mine = draw[where == r[0]]
            found = mine[max(1, len(mine) // parts[r[0]]) :: max(1, len(mine) // parts[r[0]])]
            # A group that fills a range by itself is cut off on both sides. Every cut lies above the least hash, so each round goes on.
            found = [h for x in found.tolist() for h in (x, x + 1) if r[3] < h <= r[4]]
            more += found or [r[4]]
        cuts = np.unique(np.r_[cuts, np.array(more, np.int64)])


def shards(docs: DataFrame, n: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, shard, slot, oversize) for each row, shards 0..n-1 of near equal bytes and slots gapless from 0 in each.

    Size is the text's UTF-8 bytes plus 1 (a null text: 1, with checksum 0; it equals the empty one). Rows with equal texts always share a shard, so
    the bytes of two shards differ by one group's at most. `oversize` marks rows of a group that is larger than an even share of what the larger ones
    leave; each has a shard to itself, and the others are equal among themselves. Repeated rows and null ids get a row each; an empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("h"))
    rows = durable(rows.withColumn("tie", F.monotonically_increasing_id())).withColumn("part", F.shiftrightunsigned("tie", 33))
    # A group is numbered part by part, so that no task holds all rows of one.
    parts = durable(rows.groupBy("h", "part").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes")))
    groups = durable(parts.groupBy("h").agg(F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes")))
    left, own = groups.agg(F.sum("bytes")).first()[0] or 0, []
    for g in groups.orderBy(F.desc("bytes"), "h").limit(n - 1).collect():
        if g["bytes"] * (n - len(own)) <= left:
            break
        own.append(g["h"])
        left -= g["bytes"]
    rest, shared = groups.where(~F.col("h").isin(own)), n - len(own)
    cuts, sizes = splitters(rest, left, max(n * RANGES, left // RANGE_BYTES))
    first_row, first_byte, offsets = 0, 0, []
    for k, count, size in sizes:
        offsets.append((k, first_row, first_byte))
        first_row, first_byte = first_row + count, first_byte + size
    starts = docs.sparkSession.createDataFrame(offsets, "range int, first_row long, first_byte long")  # a row for each range
    upto = Window.partitionBy("range").orderBy("h").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.sum(c).over(upto), F.lit(0))
    placed = _ranged(rest, cuts).withColumn("row", before("rows")).withColumn("byte", before("bytes")).join(F.broadcast(starts), "range")
    middle = F.col("first_byte") + F.col("byte") + F.col("bytes") / 2
    placed = placed.select("h", F.least(F.lit(shared - 1), F.floor(middle * shared / max(1, left))).cast("int").alias("shard"), (F.col("first_row") + F.col("row")).alias("nth"), F.lit(False).alias("oversize"))
    alone = groups.where(F.col("h").isin(own)).withColumn("shard", (F.array_position(F.array(*map(F.lit, own)), F.col("h")) - 1 + shared).cast("int")) if own else None
    if alone is not None:
        placed = placed.unionByName(alone.select("h", "shard", F.lit(0).cast("long").alias("nth"), F.lit(True).alias("oversize")))
    placed = durable(placed)
    begins = placed.groupBy("shard").agg(F.min("nth").alias("begin"))  # n rows
    placed = placed.join(F.broadcast(begins), "shard").select("h", "shard", (F.col("nth") - F.col("begin")).alias("nth"), "oversize")
    earlier = Window.partitionBy("h").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    dealt = parts.withColumn("earlier", F.coalesce(F.sum("rows").over(earlier), F.lit(0))).join(placed, "h")
    dealt = dealt.select("h", "part", "shard", (F.col("nth") + F.col("earlier")).alias("from"), "oversize")
    order = Window.partitionBy("h", "part").orderBy("tie")
    numbered = rows.withColumn("in_part", F.row_number().over(order) - 1).join(dealt, ["h", "part"])
    return numbered.select(id_col, "size", "text_crc32", "shard", (F.col("from") + F.col("in_part")).alias("slot"), "oversize")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shards(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "oversize")
