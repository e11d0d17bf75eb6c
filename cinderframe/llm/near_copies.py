"""Near copies: all texts whose shingle sets have a Jaccard similarity of SIMILARITY or more to one another, found by SimHash and completed by an exact set join.

The SimHash tries come first, over fingerprints of the sets: they link whatever lies within their budget of 2 bits. At a similarity of 0.8 two fingerprints lie about
10 of 64 bits apart, beyond any budget that a trie can walk, so what they cannot see is joined by the sets. Two sets of that similarity agree on a shingle
among the first n - ceil(SIMILARITY n) + 1 of each in any common order, so these prefixes are joined. The order has rare shingles first, by the
counts of a sample, so that common lines meet in no prefix; which sample it is changes the work and never the result. Members of a
shingle lie in order of size and are paired at growing distances. Pairs that are linked already are left out, as are those whose sketches, parity bits that bound the
difference of the sets from below, tell them apart; so a large group of near copies is not paired with itself. From the second round on a pair is left out, too, where both have one of the last few
shingles before this one in common, as they meet there: near copies share many shingles, and only the least of them need bring them together. What is left is checked by its sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .buffers import slices, span_hashes, whole_groups, word_spans
from .components import components
from .simhash import LOWER, majority
from .simhash import links as trie_links
from .tables import durable, release, spare, stored

#: Words of a shingle, and the least Jaccard similarity of near copies.
WORDS, SIMILARITY = 5, 0.8
#: Documents of the sample that orders the shingles, and the most shingles that are held as common.
SAMPLE, COMMON = 20_000, 2**18
#: Least bits of a set's parity, a power of two that is no less than the set: bit k is the number of shingles that fall on k, modulo 2. The sketch is the same for so many bits, and goes along with every member of a shingle.
PARITY, SKETCH = 1024, 512
#: Distances of the first round, and how much farther each next one reaches.
REACH, WIDER = 2, 16
#: So many shingles before one, by value, tell whether two members have met there already.
PRIOR = 4

LOWER_BYTES = np.frombuffer(LOWER, np.uint8)


def shingle_sets(data: np.ndarray, bounds: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, row, edges): the distinct shingles of each row, sorted, their rows, and where each row's begin.

    Words are runs of `[^\\x20\\x09-\\x0D]+` with A-Z lower-cased; shingles are `words` of them, or the whole sequence if there are fewer.
    """
    data = LOWER_BYTES[data]
    starts, ends, row = word_spans(data, bounds)
    word = span_hashes(data, starts, ends)
    first = np.searchsorted(row, np.arange(len(bounds)))
    n = np.arange(len(word))
    begins = (n + words <= first[1:][row]) | (n == first[:-1][row])
    n, row = n[begins], row[begins]
    h = span_hashes(word, n, np.minimum(n + words, first[1:][row]))
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    h, row = h[new], row[new]
    return h, row, np.searchsorted(row, np.arange(len(bounds)))


def set_keys(h: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """A 64-bit key of each set; 0 for the empty one."""
    return span_hashes(h, edges[:-1], edges[1:]).view(np.int64)


def _common(docs: DataFrame, text_col: str, words: int, sample: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that stand in two sampled documents or more, sorted, with their counts; COMMON of them at most, by count."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, bounds in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([pa.array(shingle_sets(data, bounds, words)[0].view(np.int64))], ["h"])

    total = docs.count()
    drawn = docs if total <= sample else docs.sample(sample / total, 7)
    counts = drawn.select(F.col(text_col).alias("text")).mapInArrow(scan, "h long").groupBy("h").agg(F.count("*").alias("n"))
    found = counts.where("n > 1").orderBy(F.desc("n"), "h").limit(COMMON).toArrow()
    h, n = found.column("h").to_numpy().view(np.uint64), found.column("n").to_numpy()
    order = np.argsort(h)
    return h[order], n[order]


def _parity(h: np.ndarray) -> bytes:
    """The parity of one set, of the least power of two bits that is no less than its size."""
    bits = 1 << (len(h) - 1).bit_length()
    return np.packbits((np.bincount((h % np.uint64(bits)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)).tobytes()


def _folded(packed: np.ndarray, width: int) -> np.ndarray:
    """Parities, a row each, as those of fewer bits: `width` bytes, of which the rows have a multiple."""
    return np.bitwise_xor.reduce(packed.reshape(len(packed), -1, width), axis=1)


def _rows(docs: DataFrame, id_col: str, text_col: str, words: int, share: tuple[int, int], sample: int) -> DataFrame:
    """(id, node, n, fp, parity, sketch, prefix) of each row: the key of its set, the set's size, fingerprint, parity and sketch, and its rarest shingles."""
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("node", T.LongType()), T.StructField("n", T.IntegerType()), T.StructField("fp", T.LongType()), T.StructField("parity", T.BinaryType()), T.StructField("sketch", T.BinaryType()), T.StructField("prefix", T.ArrayType(T.LongType()))])
    told = docs.sparkSession.sparkContext.broadcast(_common(docs, text_col, words, sample))
    num, den = share

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = told.value
        for rows, data, bounds in slices(batches, "text"):
            h, row, edges = shingle_sets(data, bounds, words)
            size = np.diff(edges)
            count = np.zeros(len(h), np.int64)
            if len(known) and len(h):
                at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                count = np.where(known[at] == h, counts[at], 0)
            order = np.lexsort((h, count, row))
            length = np.where(size > 0, size - -(-size * num // den) + 1, 0)
            taken = h[order][np.arange(len(h)) - edges[:-1][row] < length[row]]
            prefix = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(length)].astype(np.int32)), pa.array(taken.view(np.int64)))
            parity, sketch = [], []
            for a in range(0, len(size), 256):  # the bits of so many rows at once
                b = min(a + 256, len(size))
                part = slice(edges[a], edges[b])
                bits = np.bincount((row[part] - a) * PARITY + (h[part] % np.uint64(PARITY)).astype(np.int64), minlength=(b - a) * PARITY)
                packed = np.packbits((bits & 1).astype(np.uint8).reshape(-1, PARITY), axis=1)
                parity += [x.tobytes() for x in packed]
                sketch += [x.tobytes() for x in _folded(packed, SKETCH // 8)]
            for k in np.flatnonzero(size > PARITY).tolist():  # parities of large sets would fill up
                parity[k] = _parity(h[edges[k] : edges[k + 1]])
            columns = [pa.array(set_keys(h, edges)), pa.array(size.astype(np.int32)), pa.array(majority(h, edges).view(np.int64)), pa.array(parity, pa.binary()), pa.array(sketch, pa.binary())]
            yield pa.RecordBatch.from_arrays([rows.column(0), *columns, prefix], schema.names)

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(scan, schema)


def _members(batches: Iterator[pa.RecordBatch], share: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """Of rows (shingle, n, node) sorted so, those with another of a fitting size in their shingle: (shingle, n, node, members)."""
    num, den = share
    for rows in whole_groups(batches, ["shingle"]):
        shingle, n = rows.column("shingle").to_numpy(), rows.column("n").to_numpy().astype(np.int64)
        fits = (shingle[1:] == shingle[:-1]) & (n[:-1] * den >= num * n[1:])
        keep = np.r_[fits, False] | np.r_[False, fits]
        at = np.flatnonzero(keep)
        if not len(at):
            continue
        _, group, members = np.unique(shingle[at], return_inverse=True, return_counts=True)
        yield pa.RecordBatch.from_arrays([rows.column(k).combine_chunks().take(pa.array(at)) for k in ("shingle", "n", "node")] + [pa.array(members[group].astype(np.int32))], ["shingle", "n", "node", "members"])


def _apart(x: np.ndarray, y: np.ndarray, size: np.ndarray, share: tuple[int, int]) -> np.ndarray:
    """Where sketches rule the similarity out for sets of `size` shingles together: sets that differ in d bits differ in d shingles or more."""
    num, den = share
    return np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64) * (den + num) > size * (den - num)


def _met(prior: np.ndarray, shingle: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Where members i and j have an earlier shingle in common; `prior` holds a member's last ones before this, or this one for want of them."""
    out = np.zeros(len(i), bool)
    for x in prior:
        mine = x[i]
        for y in prior:
            out |= (mine == y[j]) & (mine != shingle[i])
    return out


def _pairs(batches: Iterator[pa.RecordBatch], share: tuple[int, int], least: int, most: int) -> Iterator[pa.RecordBatch]:
    """Pairs of members of a shingle that lie least to most - 1 rows apart, fit in size and sketch, are not linked yet and have not met at an earlier shingle (columns p0, p1, ..., if any)."""
    num, den = share
    for rows in whole_groups(batches, ["shingle"]):
        shingle, n, node, root = (rows.column(k).to_numpy() for k in ("shingle", "n", "node", "root"))
        prior = [rows.column(k).to_numpy() for k in rows.schema.names if k[0] == "p"]
        sketch = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint64).reshape(len(n), -1)
        n = n.astype(np.int64)
        left = np.arange(len(n))
        for d in range(least, min(most, len(n))):
            left = left[left + d < len(n)]
            left = left[(shingle[left + d] == shingle[left]) & (n[left] * den >= num * n[left + d])]  # members lie by size: who fits at no distance fits at no larger one
            if not len(left):
                break
            i = left[root[left + d] != root[left]]
            i = i[~_apart(sketch[i], sketch[i + d], n[i] + n[i + d], share)]
            i = i[~_met(prior, shingle, i, i + d)]
            if len(i):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(node[i], node[i + d])), pa.array(np.maximum(node[i], node[i + d]))], ["a", "b"])


def _close(batches: Iterator[pa.RecordBatch], share: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """Pairs whose parities do not rule out the similarity."""
    for rows in batches:
        size = rows.column("na").to_numpy().astype(np.int64) + rows.column("nb").to_numpy()
        x, y = (rows.column(k).to_pylist() for k in "xy")
        width = np.array([min(len(p), len(q)) for p, q in zip(x, y, strict=True)], np.int64)
        near = np.zeros(len(size), bool)
        for w in np.unique(width).tolist():
            at = np.flatnonzero(width == w)
            for k in range(0, len(at), max(1, 2**22 // w)):
                some = at[k : k + max(1, 2**22 // w)]
                left, right = (np.frombuffer(b"".join(_folded(np.frombuffer(v[r], np.uint8)[None], w).tobytes() if len(v[r]) > w else v[r] for r in some.tolist()), np.uint64).reshape(len(some), -1) for v in (x, y))
                near[some] = ~_apart(left, right, size[some], share)
        yield rows.select(["a", "b"]).filter(pa.array(near))


def _similar(batches: Iterator[pa.RecordBatch], share: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    num, den = share
    for rows in batches:
        keep = []
        for x, y in zip(rows.column("x"), rows.column("y"), strict=True):
            x, y = x.values.to_numpy(), y.values.to_numpy()
            both = len(np.intersect1d(x, y, True))
            keep.append(both * den >= num * (len(x) + len(y) - both))
        yield rows.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _sets(docs: DataFrame, rows: DataFrame, nodes: DataFrame, id_col: str, text_col: str, words: int) -> tuple[DataFrame, str]:
    """(node, set) of the nodes asked for, from the text of one of their rows, and the path of a table that release() drops with it.

    The ids are stored first, so that Spark knows their size and does not shuffle all texts for a few of them.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, bounds in slices(batches, "text"):
            h, _, edges = shingle_sets(data, bounds, words)
            sets = pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(h.view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(set_keys(h, edges)), sets], ["node", "set"])

    ids, at_ids = stored(rows.join(nodes, "node", "left_semi").groupBy("node").agg(F.min("id").alias("__id")).select("__id").distinct())
    texts = docs.join(ids, docs[id_col].eqNullSafe(ids["__id"]), "left_semi").select(F.col(text_col).alias("text"))
    found = texts.mapInArrow(scan, "node long, set array<long>").join(nodes, "node", "left_semi")
    return found.groupBy("node").agg(F.first("set").alias("set")), at_ids


def _by_tries(nodes: DataFrame) -> DataFrame:
    """(a, b): sets whose fingerprints the tries link; those of one fingerprint by way of the least of them."""
    least = nodes.groupBy("fp").agg(F.min("node").alias("least"))
    equal = nodes.select("fp", "node").join(least, "fp").where("node != least").select(F.col("least").alias("a"), F.col("node").alias("b"))
    linked = trie_links(durable(least.select("fp")))
    left, right = (least.select(F.col("fp").alias(k), F.col("least").alias(f"node_{k}")) for k in ("a", "b"))
    far = linked.join(left, "a").join(right, "b").select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b"))
    return equal.unionByName(far).distinct()


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, similarity: float = SIMILARITY, sample: int = SAMPLE) -> DataFrame:
    """(id, node, keep): each row with its set's key; keep is true for the row that stays of its component, that of the smallest id.

    A component is all that links of `similarity` or more reach; equal sets link, empty ones among them. A row with a null id stays only if no
    row of its component has an id. Repeated rows are told alike. An empty table gives no rows.
    """
    spark, share = docs.sparkSession, Fraction(str(similarity)).as_integer_ratio()
    every, at_every = stored(_rows(docs, id_col, text_col, words, share, sample))
    rows, at_rows = stored(every.select("id", "node"))
    full, at_full = stored(every.groupBy("node").agg(*(F.first(c).alias(c) for c in ("n", "fp", "parity", "sketch", "prefix"))))
    nodes, at_nodes = stored(full.drop("prefix"))
    del every
    release(spark, at_every)
    split = full.select(F.explode("prefix").alias("shingle"), "n", "node")
    key = ["shingle", "n", "node"]
    members, at_members = stored(split.repartition("shingle").sortWithinPartitions(*key).mapInArrow(lambda b: _members(b, share), "shingle long, n int, node long, members int"))
    del split, full
    release(spark, at_full)
    largest = members.agg(F.max("members")).first()[0] or 0
    paths, links, roots = [at_rows, at_nodes, at_members], None, None
    told, prior = nodes.select("node", "n", "parity"), [f"p{k}" for k in range(PRIOR)]

    def verified(pairs: DataFrame) -> None:
        """Adds the pairs that are similar to the links, and renews the roots."""
        nonlocal links, roots
        left, right = (told.select(F.col("node").alias(k), F.col("n").alias(f"n{k}"), F.col("parity").alias(p)) for k, p in (("a", "x"), ("b", "y")))
        close, at_close = stored(pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", "x", "y").mapInArrow(lambda b: _close(b, share), "a long, b long"))
        if close.isEmpty():
            release(spark, at_close)
            return
        asked, at_asked = stored(close.select(F.explode(F.array("a", "b")).alias("node")).distinct())
        found_sets, at_ids = _sets(docs, rows, asked, id_col, text_col, words)
        sets, at_sets = stored(found_sets)
        del found_sets
        release(spark, at_ids)
        left, right = (sets.select(F.col("node").alias(k), F.col("set").alias(p)) for k, p in (("a", "x"), ("b", "y")))
        found, at_found = stored(close.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(lambda b: _similar(b, share), "a long, b long"))
        links = found if links is None else links.unionByName(found)
        roots, at_roots = stored(components(links))
        paths.extend([at_found, at_roots])
        del close, asked, sets, left, right
        release(spark, at_close, at_asked, at_sets)

    verified(_by_tries(nodes))
    least, most = 1, REACH
    while least < largest:
        some, told_by = members.where(F.col("members") > least), []
        if least > 1:  # in the first round, of neighbours alone, every shingle links what it can
            before, told_by = Window.partitionBy("node").orderBy("shingle"), prior
            some = some.select(*key, *(F.coalesce(F.lag("shingle", k + 1).over(before), "shingle").alias(p) for k, p in enumerate(prior)))
        some = some.join(nodes.select("node", "sketch"), "node")
        some = some.withColumn("root", F.col("node")) if roots is None else some.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        some = some.select(*key, "root", "sketch", *told_by).repartition("shingle").sortWithinPartitions(*key)
        verified(some.mapInArrow(lambda b, least=least, most=most: _pairs(b, share, least, most), "a long, b long").distinct())
        least, most = most, most * WIDER
    named = rows.select("id", "node")
    named = named.withColumn("root", F.col("node")) if roots is None else named.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    place = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("node").alias("node"))
    kept = named.groupBy("root").agg(F.min(place).alias("kept"))
    out = durable(named.join(kept, "root").select("id", "node", (F.col("id").eqNullSafe(F.col("kept.id")) & (F.col("node") == F.col("kept.node"))).alias("keep")))
    release(spark, *paths)
    return out


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """The document with the smallest id of each component, with all its columns.

    Rows that share an id, null ids among them, are told apart by their sets; of those that share a set too, repeated rows, all stay or go. An empty table gives no rows.
    """
    told = near_copies(docs, id_col, text_col, words, similarity)
    gone, _ = stored(told.where("not keep").select(F.col("id").alias("__id"), F.col("node").alias("__node")).distinct())
    if told.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        return docs.join(gone, docs[id_col].eqNullSafe(gone["__id"]), "left_anti")
    names, key = docs.columns, spare(docs, "__key")
    schema = T.StructType([*docs.schema.fields, T.StructField(key, T.LongType())])

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, bounds in slices(batches, text_col):
            h, _, edges = shingle_sets(data, bounds, words)
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(set_keys(h, edges))], [*names, key])

    marked = docs.mapInArrow(keyed, schema)
    return marked.join(gone, marked[id_col].eqNullSafe(gone["__id"]) & (marked[key] == gone["__node"]), "left_anti").drop(key)
