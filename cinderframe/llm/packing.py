"""Best-fit packing of documents into sequences of several permitted lengths.

Items are dealt to bounded packing groups by a hash, so that each group is packed by one task whatever the corpus holds.
In a group, items go in order of falling length to the open bin with the least room that takes them. Where none does, a bin is opened; at the end
each bin shrinks to the least permitted length for its contents. Which length is opened for an item is decided for all lengths together: a plan
names one for each class of item lengths, and the plan whose packing costs least after shrinking is searched from several starts, class by class.
"""

from __future__ import annotations

import bisect
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import durable, read

#: Permitted sequence lengths in tokens; a token is a UTF-8 byte here, and each document ends with one more.
LENGTHS = (1024, 2048, 4096, 8192, 16384)
#: Tokens of one packing group.
GROUP_TOKENS = 2_000_000
#: Groups that a task packs, about, and the tasks at most.
GROUPS_PER_TASK, MOST_TASKS = 4, 20_000
#: Cost of a bin: its length, a share for attention that grows with the square, and a fixed part.
ATTENTION, FIXED = 1 / 65536, 64


#: Rounds in which so many bins of a group are packed anew.
ROUNDS, REPACKED = 8, 32


def cost(length: int) -> float:
    return FIXED + length * (1 + length * ATTENTION)


class Room:
    """Open bins by room left: the least room of at least a given size in a few steps (a bitmap of 64-bit words)."""

    def __init__(self, most: int):
        self.bins: list[list[int]] = [[] for _ in range(most + 1)]
        self.rooms: list[int] = []  # sorted rooms that have a bin

    def add(self, room: int, b: int) -> None:
        if not self.bins[room]:
            bisect.insort(self.rooms, room)
        self.bins[room].append(b)

    def take(self, size: int) -> tuple[int, int] | None:
        at = bisect.bisect_left(self.rooms, size)
        if at == len(self.rooms):
            return None
        room = self.rooms[at]
        b = self.bins[room].pop()
        if not self.bins[room]:
            del self.rooms[at]
        return room, b


def classes(lengths: Sequence[int]) -> list[int]:
    """Upper ends of the classes of item lengths: the permitted lengths and their halves and thirds, as one, two or three such items fill a bin."""
    return sorted({c // d for c in lengths for d in (1, 2, 3)} - {0})


def best_fit(sizes: Sequence[int], lengths: Sequence[int], opened: Sequence[int]) -> tuple[list[int], list[int], list[int]]:
    """(bin of each item, start of each item in its bin, length of each bin) for items in order of falling size.

    opened[i]: the length of a bin that is opened for an item of class i of classes(lengths).
    """
    ends, room, bins, starts, used = classes(lengths), Room(lengths[-1]), [], [], []
    for size in sizes:
        found = room.take(size)
        if found is None:
            found = opened[bisect.bisect_left(ends, size)], len(used)
            used.append(0)
        space, b = found
        bins.append(b)
        starts.append(used[b])
        used[b] += size
        if space > size:
            room.add(space - size, b)
    return bins, starts, [lengths[bisect.bisect_left(lengths, u)] for u in used]


def planned(sizes: Sequence[int], lengths: Sequence[int], uniform: bool = False) -> tuple[list[int], list[int], list[int]]:
    """best_fit() by the plan of least total cost that the search meets: the best uniform plan, then class by class what costs less (not if `uniform`)."""
    ends = classes(lengths)
    least = [bisect.bisect_left(lengths, e) for e in ends]
    held = sorted({bisect.bisect_left(ends, s) for s in sizes})  # classes that have an item
    tried: dict[tuple[int, ...], tuple[float, tuple]] = {}

    def priced(plan: tuple[int, ...]) -> float:
        if plan not in tried:
            got = best_fit(sizes, lengths, plan)
            tried[plan] = sum(map(cost, got[2])), got
        return tried[plan][0]

    best = min((tuple(max(c, lengths[k]) for k in least) for c in lengths), key=priced)
    pays = not uniform
    while pays:
        before = priced(best)
        for i in held:
            best = min((best, *((*best[:i], c, *best[i + 1 :]) for c in lengths[least[i] :])), key=priced)
        pays = priced(best) < before
    return tried[best][1]


def pack(sizes: Sequence[int], lengths: Sequence[int] = LENGTHS, rounds: int = ROUNDS, seed: int = 0) -> tuple[list[int], list[int], list[int]]:
    """planned() for all items at once; then, again and again, for the items of some bins alone, kept where that costs less.

    Half of those bins are the ones that waste most, half are drawn; a bin that gives way loses no item.
    """
    lengths = sorted(lengths)
    bins, starts, used = planned(sizes, lengths)
    members: list[list[int]] = [[] for _ in used]
    for item, b in enumerate(bins):
        members[b].append(item)
    draw = np.random.default_rng(seed)
    for _ in range(rounds if len(members) > 1 else 0):
        waste = np.array([cost(c) * (1 - sum(sizes[i] for i in m) / c) for m, c in zip(members, used, strict=True)])
        some = set(np.argsort(-waste, kind="stable")[: REPACKED // 2].tolist()) | set(draw.integers(0, len(members), REPACKED // 2).tolist())
        items = sorted(i for b in some for i in members[b])  # falling sizes, as all items are
        found, _, anew = planned([sizes[i] for i in items], lengths, True)
        if sum(map(cost, anew)) < sum(cost(used[b]) for b in some):
            parts: list[list[int]] = [[] for _ in anew]
            for i, b in zip(items, found, strict=True):
                parts[b].append(i)
            members = [m for b, m in enumerate(members) if b not in some] + parts
            used = [c for b, c in enumerate(used) if b not in some] + anew
    for b, m in enumerate(members):
        at = 0
        for i in m:
            bins[i], starts[i], at = b, at, at + sizes[i]
    return bins, starts, used


#: Rows of one id and length that are numbered at once.
ALIKE = 100_000


def packed(docs: DataFrame, lengths: Sequence[int] = LENGTHS, tokens: Column | None = None, id_col: str = "doc_id", text_col: str = "text", group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """(id, part, from, tokens, group, bin, start, bin_length, bin_tokens): where each piece of each document lies.

    `tokens` is the length of a document's token sequence (default: UTF-8 bytes of the text, plus 1 for its end). Documents longer than the longest length
    are cut into pieces of that length and a rest; nothing is dropped. A null or empty text is its end token; where `tokens` is null, 0 or less, a
    document is one piece of no tokens. Repeated rows are packed each; a null id packs like any other. An empty table gives no rows.
    """
    most = max(lengths)
    size = F.coalesce(F.octet_length(text_col), F.lit(0)) + 1 if tokens is None else tokens
    plain = docs.select(F.col(id_col), F.greatest(F.coalesce(size.cast("long"), F.lit(0)), F.lit(0)).cast("long").alias("n"))
    # Rows that share id and length are numbered, a block at a time: the same table is dealt alike however it is split.
    alike = plain.groupBy(id_col, "n").agg(F.count("*").alias("__c")).withColumn("__b", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("__c") - 1) / ALIKE))))
    nth = F.explode(F.sequence(F.col("__b") * ALIKE, F.least(F.col("__c"), (F.col("__b") + 1) * ALIKE) - 1)).alias("__nth")
    rows = durable(alike.select(id_col, "n", nth).select(id_col, "n", F.xxhash64(F.col(id_col), "n", "__nth").alias("salt")))
    total = rows.agg(F.sum("n")).first()[0] or 0
    groups = max(1, -(-total // group_tokens))
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0), F.floor((F.col("n") - 1) / most)).cast("long"))).alias("part")
    items = rows.select(F.col(id_col), "n", "salt", part).select(id_col, "part", (F.col("part") * most).alias("from"), F.least(F.lit(most), F.col("n") - F.col("part") * most).alias("tokens"), F.pmod(F.xxhash64("salt", "part"), F.lit(groups)).cast("int").alias("group"))
    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, kind), *(T.StructField(k, t) for k, t in (("part", T.LongType()), ("from", T.LongType()), ("tokens", T.LongType()), ("group", T.IntegerType()), ("bin", T.IntegerType()), ("start", T.LongType()), ("bin_length", T.IntegerType()), ("bin_tokens", T.LongType())))])

    def one(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["tokens", id_col, "part"], ascending=[False, True, True], kind="stable")
        bins, starts, lengths_ = pack(group["tokens"].tolist(), lengths)
        held = np.bincount(bins, weights=group["tokens"], minlength=len(lengths_)).astype(np.int64)
        return group.assign(bin=np.array(bins, np.int32), start=np.array(starts, np.int64), bin_length=np.array(lengths_, np.int32)[bins], bin_tokens=held[bins])[schema.names]

    # Rows are small and packing them is not: tasks by the number of groups, which a coalescing by bytes would join.
    return items.repartition(min(MOST_TASKS, -(-groups // GROUPS_PER_TASK)), "group").groupBy("group").applyInPandas(one, schema)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(read(spark, sf_dir, "documents"))
