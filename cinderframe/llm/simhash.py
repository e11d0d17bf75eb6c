"""SimHash near-duplicates: a self-join of binary tries over fingerprints.

Two 64-bit fingerprints at Hamming distance 2 or less agree on two of four 16-bit blocks. So each distinct fingerprint goes
into six tries, one for each pair of blocks. These 32 bits form the upper levels, where no bit may differ: they serve as a table by their value, as
the pigeonhole principle has it. The other 32 bits are the lower levels, where node pairs are walked together with their differing bits added up. Large upper nodes are walked level by level as rows of Spark (a row for each member of each
node pair within the budget), until every node pair is small; small ones are finished inside a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .buffers import slices, word_spans
from .components import components
from .tables import durable, read

#: Differing bits that still link two fingerprints.
BUDGET = 2
BLOCKS, BLOCK_BITS = 4, 16
#: Most members of a node pair that one task finishes; larger ones are walked down a level of STEP bits in Spark.
SMALL, STEP = 2048, 8
#: A leaf of the walk inside a task: so few members are compared bit by bit.
LEAF = 8

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def majority(h: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Of each run h[edges[i]:edges[i+1]] of 64-bit hashes the number whose bits are set in over half of them; 0 for an empty run."""
    weights = np.uint64(1) << np.arange(63, -1, -1, dtype=np.uint64)
    out = np.zeros(len(edges) - 1, np.uint64)
    some = np.flatnonzero(np.diff(edges) > 0)
    for a in range(0, len(some), 256):  # the bits of so many runs at once
        runs = some[a : a + 256]
        lo, hi = edges[runs[0]], edges[runs[-1] + 1]
        bits = np.unpackbits(h[lo:hi].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones = np.add.reduceat(bits, edges[runs] - lo, axis=0, dtype=np.int32)
        out[runs] = ((2 * ones > np.diff(edges)[runs][:, None]) * weights).sum(axis=1, dtype=np.uint64)
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """(id, fp): the 64-bit SimHash of each whole text as a signed long.

    Words are runs of `[^\\x20\\x09-\\x0D]+` of the text with A-Z lower-cased; shingles are `words` of them, repeats included, joined by a
    space, or the whole sequence if there are fewer. A bit is 1 if it is set in over half of the shingles' XXH64 values (seed 42). No
    words, null included: 0.
    """
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("fp", T.LongType())])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        for rows, data, bounds in slices(batches, "text"):
            starts, ends, row = word_spans(data, bounds)
            out = np.zeros(rows.num_rows, np.uint64)
            if len(starts):
                # The words again, one space after each.
                lengths = ends - starts + 1
                at = np.zeros(len(starts) + 1, np.int64)
                np.cumsum(lengths, out=at[1:])
                source = np.repeat(starts - at[:-1], lengths) + np.arange(at[-1])
                joined = data[np.minimum(source, len(data) - 1)]
                joined[at[1:] - 1] = 32
                whole = joined.tobytes().translate(LOWER)
                per_row = np.bincount(row, minlength=rows.num_rows)
                first = np.cumsum(per_row) - per_row
                last_word = (first + per_row)[row] - 1
                n = np.arange(len(starts))
                begins = (n + words - 1 <= last_word) | (n == first[row])
                stop = np.minimum(n + words - 1, last_word)[begins]
                h = np.fromiter((digest(whole[a:b], 42) for a, b in zip(at[:-1][begins].tolist(), (at[1:][stop] - 1).tolist(), strict=True)), np.uint64, int(begins.sum()))
                of = row[begins]
                out = majority(h, np.searchsorted(of, np.arange(rows.num_rows + 1)))
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(out.view(np.int64))], [id_col, "fp"])

    return docs.select(F.col(id_col), F.col(text_col).alias("text")).mapInArrow(hashed, schema)


def _trie(pair: tuple[int, int]) -> Column:
    """A fingerprint with the blocks of `pair` moved to its upper half."""
    order = [*pair, *(k for k in range(BLOCKS) if k not in pair)]
    parts = [F.shiftleft(F.shiftrightunsigned("fp", (BLOCKS - 1 - k) * BLOCK_BITS).bitwiseAND(F.lit(2**BLOCK_BITS - 1)), (BLOCKS - 1 - at) * BLOCK_BITS) for at, k in enumerate(order)]
    out = parts[0]
    for x in parts[1:]:
        out = out.bitwiseOR(x)
    return out


def walk(left: np.ndarray, right: np.ndarray, same: bool, bit: int, budget: int, found: list) -> None:
    """Links between two nodes of a trie whose members are sorted numbers below 2**(bit+1); same: both are one node."""
    if not len(left) or not len(right) or same and len(left) < 2:
        return
    if min(len(left), len(right)) <= LEAF or bit < 0:
        apart = np.bitwise_count((left[:, None] ^ right[None, :]) & np.uint64(2 ** (bit + 1) - 1)) <= budget
        if same:
            apart &= left[:, None] < right[None, :]
        i, j = np.nonzero(apart)
        if len(i):
            found.append((left[i], right[j]))
        return
    mask = np.uint64(1 << bit)
    cut = [int(np.count_nonzero(x & mask == 0)) for x in (left, right)]
    l0, l1, r0, r1 = left[: cut[0]], left[cut[0] :], right[: cut[1]], right[cut[1] :]
    walk(l0, r0, same, bit - 1, budget, found)
    walk(l1, r1, same, bit - 1, budget, found)
    if budget:
        walk(l0, r1, False, bit - 1, budget - 1, found)
        if not same:
            walk(l1, r0, False, bit - 1, budget - 1, found)


def _forest(pairs: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[int, int]]:
    """Links that join the same fingerprints with no link more than that needs."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    out = []
    for a, b in pairs:
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            p, q = root(x), root(y)
            if p != q:
                parent[max(p, q)] = min(p, q)
                out.append((x, y))
    return out


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rest of each node pair: rows (trie, upper, l_node, r_node, depth, errors, side, path, fp), sorted by node pair, side and path."""
    held: list[pa.RecordBatch] = []

    def done(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        names = ("trie", "upper", "l_node", "r_node", "depth", "errors", "side")
        column = {k: rows.column(k).to_numpy() for k in names}
        path, fp = rows.column("path").to_numpy().astype(np.uint64), rows.column("fp").to_numpy()
        new = np.zeros(len(path), bool)
        new[:1] = True
        for k in names[:4]:
            new[1:] |= column[k][1:] != column[k][:-1]
        at = np.r_[np.flatnonzero(new), len(path)]
        back, pairs = dict(zip(path.tolist(), fp.tolist(), strict=True)), []
        for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            if b - a < 2:
                continue
            if b - a == 2:  # most pairs: compared at once
                apart = column["l_node"][a] != column["r_node"][a] and column["side"][a] == column["side"][b - 1]
                if not apart and (int(fp[a] ^ fp[b - 1]) & (2**64 - 1)).bit_count() <= BUDGET:
                    pairs.append((fp[a : a + 1], fp[b - 1 : b]))
                continue
            found: list = []
            budget, bit = BUDGET - int(column["errors"][a]), 31 - int(column["depth"][a])
            if column["l_node"][a] == column["r_node"][a]:
                walk(path[a:b], path[a:b], True, bit, budget, found)
            else:
                mid = a + int(np.count_nonzero(column["side"][a:b] == 0))
                walk(path[a:mid], path[mid:b], False, bit, budget, found)
            for x, y in found:
                pairs.append((np.array([back[v] for v in x.tolist()], np.int64), np.array([back[v] for v in y.tolist()], np.int64)))
        links = _forest(pairs)
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())], ["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows = pa.Table.from_batches(held)
        key = [rows.column(k).to_numpy() for k in ("trie", "upper", "l_node", "r_node")]
        open_from = int(np.flatnonzero(np.logical_or.reduce([k != k[-1] for k in key]))[-1] + 1) if any((k != k[-1]).any() for k in key) else 0
        if open_from:
            yield from done(rows.slice(0, open_from))
            held = rows.slice(open_from).combine_chunks().to_batches()
    if held:
        yield from done(pa.Table.from_batches(held))


def links(fps: DataFrame, small: int = SMALL) -> DataFrame:
    """(a, b): links between distinct fingerprints (column fp, each once) at BUDGET or fewer differing bits.

    All pairs are looked at; of those that one task finds, a spanning forest is returned, which reaches the same components.
    """
    tries = F.array(*[F.struct(F.lit(k).alias("trie"), _trie(pair).alias("path")) for k, pair in enumerate(combinations(range(BLOCKS), 2))])
    zero = F.lit(0).cast("long")
    rows = fps.select("fp", F.explode(tries).alias("t")).select(F.col("t.trie").alias("trie"), F.shiftrightunsigned("t.path", 32).alias("upper"), zero.alias("l_node"), zero.alias("r_node"), F.lit(0).alias("depth"), F.lit(0).alias("errors"), F.lit(0).alias("side"), F.col("t.path").alias("path"), "fp")
    node = ["trie", "upper", "l_node", "r_node"]
    out, depth = None, 0
    while True:
        sizes = rows.groupBy(node).agg(F.count("*").alias("members"))
        # Upper nodes of one member link nothing; they are the bulk and stop here.
        large = durable(sizes.where(f"members > {small}").select(node)) if depth < 32 else None
        final = large is None or large.isEmpty()
        ready = rows if final else rows.join(large, node, "left_anti")
        ready = ready.repartition(*node).sortWithinPartitions(*node, "side", "path").mapInArrow(_finish, "a long, b long")
        out = ready if out is None else out.unionByName(ready)
        if final:
            return out
        rows, depth = durable(_down(rows.join(large, node, "left_semi"), depth)), depth + STEP


def _down(rows: DataFrame, depth: int) -> DataFrame:
    """Members of large node pairs, dealt to the pairs of their children that stay within the budget."""
    flips = [m for m in range(2**STEP) if m.bit_count() <= BUDGET]
    child = F.shiftrightunsigned("path", 32 - depth - STEP).bitwiseAND(F.lit(2**STEP - 1))
    mask = F.explode(F.array(*[F.struct(F.lit(m).cast("long").alias("mask"), F.lit(m.bit_count()).alias("bits")) for m in flips])).alias("flip")
    one = F.col("l_node") == F.col("r_node")
    dealt = rows.select("*", child.alias("child"), mask).where(F.col("errors") + F.col("flip.bits") <= BUDGET).withColumn("other", F.col("child").bitwiseXOR(F.col("flip.mask")))
    # Within one node a pair of children is met once, the smaller on the left; between two nodes the member's side stands.
    left = F.when(one, F.least("child", "other")).when(F.col("side") == 0, F.col("child")).otherwise(F.col("other"))
    right = F.when(one, F.greatest("child", "other")).when(F.col("side") == 0, F.col("other")).otherwise(F.col("child"))
    side = F.when(one, (F.col("child") > F.col("other")).cast("int")).otherwise(F.col("side"))
    return dealt.select("trie", "upper", (F.col("l_node") * 2**STEP + left).alias("l_node"), (F.col("r_node") * 2**STEP + right).alias("r_node"), F.lit(depth + STEP).alias("depth"), (F.col("errors") + F.col("flip.bits")).alias("errors"), side.alias("side"), "path", "fp")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp, component_id): component_id is the smallest id reachable over links between fingerprints, its own included.

    Equal fingerprints link too, fingerprint 0 of texts without words among them. Repeated rows get one row each. A null id gets a
    row and is nobody's smallest id. An empty table gives no rows.
    """
    rows = durable(fingerprints(docs, id_col, text_col))
    distinct = durable(rows.groupBy("fp").agg(F.min(id_col).alias("least")))
    nodes = components(links(distinct.select("fp")))
    roots = distinct.join(nodes, distinct.fp == nodes.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    roots = durable(roots)
    least = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    named = roots.join(least, "root").select("fp", "component_id")
    return rows.join(named, "fp").select(id_col, "fp", "component_id")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_groups(read(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
