"""Repeated passages by a sparse suffix array over all documents.

Every window of MIN_WORDS words belongs to its minimiser, the k-gram with the least hash in it (the leftmost of equals), so equal windows
belong to equal k-grams at equal offsets. Only the suffixes that start at minimisers are kept, about one in 20 words. They are
sorted by k-gram and then by the context that their windows cover; neighbours are compared:

* a k-gram without an equal neighbour is unique, and so are all its windows;
* a context equal to its neighbour's repeats an earlier one over all its windows, which is one long match;
* the rest, first of their context, are extended word by word to the left and right where contexts of one k-gram differ: their windows are hashed and matched.

The order is that of hashes of the suffixes' first words and of their contexts: words themselves, some 350 bytes for each suffix, would take about eight times the
corpus on disk. So neighbours are equal or not, and common prefixes of unequal ones come from the windows.

So a passage of MIN_WORDS words or more that occurs twice is always found, and nothing shorter is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .buffers import slices, span_hashes, whole_groups, word_spans
from .tables import durable, read, release, spare, stored

#: Words of the shortest repeat, and of the k-grams among which a minimiser is chosen.
MIN_WORDS, GRAM = 50, 12


def sliding_argmin(x: np.ndarray, w: int) -> np.ndarray:
    """Index of the leftmost least value of each w neighbours, by windows of doubled widths."""
    best, at, width = x, np.arange(len(x)), 1
    while width < w:
        step = min(width, w - width)
        n = len(best) - step
        right = best[step:] < best[:n]
        at = np.where(right, at[step:], at[:n])
        best = np.where(right, best[step:], best[:n])
        width += step
    return at


def doc_words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word hash, row, row's first word, start byte, end byte) of each word of a slice; the first words have an entry per row."""
    starts, ends, row = word_spans(data, bounds)
    words = span_hashes(data, starts, ends)
    first = np.searchsorted(row, np.arange(len(bounds)))
    return words, row, first, starts, ends


def sparse_suffixes(docs: DataFrame, id_col: str, text_col: str, min_words: int, gram: int) -> DataFrame:
    """(gram, context, doc, lo, hi): a minimiser's k-gram, the hash of all that its windows cover, and its first and last window's start."""
    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("gram", T.LongType()), T.StructField("context", T.LongType()), T.StructField("doc", kind), T.StructField("lo", T.IntegerType()), T.StructField("hi", T.IntegerType())])
    w = min_words - gram + 1

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, bounds in slices(batches, "text"):
            words, row, first, _, _ = doc_words(data, bounds)
            n = len(words) - min_words + 1
            if n <= 0:
                continue
            i = np.arange(len(words) - gram + 1)
            grams = span_hashes(words, i, i + gram)
            p = sliding_argmin(grams, w)[:n]
            ok = row[:n] == row[min_words - 1 :]
            s = np.flatnonzero(ok)
            if not len(s):
                continue
            p = p[s]
            new = np.r_[True, (p[1:] != p[:-1]) | (row[s[1:]] != row[s[:-1]])]
            lo = s[new]
            hi = s[np.r_[np.flatnonzero(new)[1:] - 1, len(s) - 1]]
            at = p[new]
            context = span_hashes(words, lo, hi + min_words) ^ ((at - lo).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
            of = row[lo]
            yield pa.RecordBatch.from_arrays([pa.array(grams[at].view(np.int64)), pa.array(context.view(np.int64)), rows.column(0).take(pa.array(of)), pa.array((lo - first[of]).astype(np.int32)), pa.array((hi - first[of]).astype(np.int32))], schema.names)

    return docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")).mapInArrow(scan, schema)


TOLD = ["gram", "doc", "lo", "hi", "first", "again", "several", "other"]


def compare_neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted suffixes, those with an equal k-gram next to them: `first` of their context, or a repeat of document `other`.

    `again`: an equal context follows; its document is then the first's `other`. `several`: its k-gram has other contexts as well. A k-gram's first suffix waits for
    that until another context or k-gram comes. At a partition's edges, where neighbours are out of sight, a suffix counts as first of its context and of several,
    and its windows decide. A suffix that stands twice, as its row does, repeats nothing.
    """
    held: pa.RecordBatch | None = None  # the last row, which waits for its right neighbour
    head: pa.Table | None = None  # a k-gram's first suffix, which waits for another context
    was_first, was_twice, was_gram, was_other, edge, was_mixed = True, False, True, None, True, True
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
        gram, context, lo = (rows.column(k).to_numpy() for k in ("gram", "context", "lo"))
        doc, docs = pa.concat_arrays(rows.column("doc").chunks), rows.column("doc").to_numpy()
        n = rows.num_rows
        same_gram, same = np.zeros(n, bool), np.zeros(n, bool)
        same_gram[1:] = gram[1:] == gram[:-1]
        same[1:] = same_gram[1:] & (context[1:] == context[:-1])
        twice = same.copy()
        twice[1:] &= (docs[1:] == docs[:-1]) & (lo[1:] == lo[:-1])
        near = same_gram.copy()
        near[:-1] |= same_gram[1:]
        again = np.r_[same[1:], False]
        first_at = np.maximum.accumulate(np.where(same, 0, np.arange(n)))
        first = ~same
        first[0], twice[0], near[0] = was_first, was_twice, near[0] | was_gram | edge
        other = doc.take(pa.array(first_at))
        if not was_first:  # the run that began before this batch
            run = int(np.argmin(np.r_[same[1:], False])) + 1
            other = pa.concat_arrays([pa.array([was_other] * run, other.type), other.slice(run)])
        other = pc.if_else(pa.array(first & again), doc.take(pa.array(np.minimum(np.arange(n) + 1, n - 1))), other)
        # Runs of one k-gram, and which of them have another context; the first one of a partition may have had one before it.
        starts = np.flatnonzero(~same_gram)
        mixed = np.logical_or.reduceat(same_gram & ~same, starts)
        mixed[0] |= was_mixed
        several = first & np.repeat(mixed, np.diff(np.r_[starts, n]))
        if head is not None and (mixed[0] or len(starts) > 1):
            yield from head.set_column(6, "several", pa.array([bool(mixed[0])])).to_batches()
            head = None
        told = pa.Table.from_arrays([*(rows.column(k) for k in ("gram", "doc", "lo", "hi")), pa.array(first), pa.array(again), pa.array(several), other], names=TOLD)
        keep = (near & ~twice) & (np.arange(n) < n - 1)
        last = int(starts[-1])
        if not mixed[-1] and last < n - 1 and (last or not was_gram):  # the open run's first suffix
            if keep[last]:
                head, keep[last] = told.slice(last, 1).combine_chunks(), False
        if keep.any():
            yield from told.take(pa.array(np.flatnonzero(keep))).combine_chunks().to_batches()
        held = rows.slice(n - 1).to_batches()[0]
        was_mixed = bool(mixed[-1])
        was_first, was_twice, was_gram, was_other, edge = bool(first[-1]), bool(twice[-1]), bool(same_gram[-1]) or (n == 1 and was_gram), other[n - 1].as_py(), n == 1 and edge
    if head is not None:
        yield from head.set_column(6, "several", pa.array([True])).to_batches()
    if held is not None and not was_twice:
        yield pa.RecordBatch.from_arrays([held.column(k) for k in ("gram", "doc", "lo", "hi")] + [pa.array([was_first]), pa.array([False]), pa.array([was_first]), pa.array([was_other], held.column("doc").type)], TOLD)


def _windows(docs: DataFrame, firsts: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """(gram, window, doc, start, again): the hash of each window of suffixes that are first of their context."""
    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("gram", T.LongType()), T.StructField("window", T.LongType()), T.StructField("doc", kind), T.StructField("start", T.IntegerType()), T.StructField("again", T.BooleanType())])

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, bounds in slices(batches, "text"):
            words, _, first, _, _ = doc_words(data, bounds)
            at = rows.column(rows.schema.get_field_index("at"))
            per_row = np.diff(at.offsets.to_numpy())
            flat = at.flatten()
            of = np.repeat(np.arange(rows.num_rows), per_row)
            gram, lo, hi, again = (flat.field(k).to_numpy(zero_copy_only=False) for k in ("gram", "lo", "hi", "again"))
            n = hi - lo + 1
            suffix = np.repeat(np.arange(len(n)), n)
            start = lo[suffix] + np.arange(len(suffix)) - np.repeat(np.cumsum(n) - n, n)
            s = first[of[suffix]] + start
            window = span_hashes(words, s, s + min_words)
            yield pa.RecordBatch.from_arrays([pa.array(gram[suffix]), pa.array(window.view(np.int64)), rows.column(0).take(pa.array(of[suffix])), pa.array(start.astype(np.int32)), pa.array(again[suffix])], schema.names)

    lists = firsts.groupBy("doc").agg(F.collect_list(F.struct("gram", "lo", "hi", "again")).alias("at"))
    texts = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    return texts.join(lists, "doc").select("doc", "text", "at").mapInArrow(extend, schema)


def merge_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans (doc, removed, start, end, other) sorted by the first three, with overlapping or touching ones made one."""
    for rows in whole_groups(batches, ["doc", "removed"]):
        doc, removed, start, end = (rows.column(k).to_numpy() for k in ("doc", "removed", "start", "end"))
        group = np.zeros(len(start), np.int64)
        group[1:] = np.cumsum((doc[1:] != doc[:-1]) | (removed[1:] != removed[:-1]))
        base = group << 32
        reach = np.maximum.accumulate(base + end)
        new = np.flatnonzero(np.r_[True, (base + start)[1:] > reach[:-1]])
        last = np.r_[new[1:], len(start)] - 1
        at = pa.array(new)
        yield pa.RecordBatch.from_arrays([rows.column("doc").combine_chunks().take(at), pa.array(removed[new]), pa.array(start[new]), pa.array((reach[last] - base[last]).astype(np.int32)), rows.column("other").combine_chunks().take(at)], ["doc", "removed", "start", "end", "other"])


def _row_keys(docs: DataFrame, id_col: str, text_col: str) -> DataFrame | None:
    """(__id, __digest, __row): a number of each distinct id and text, in order of id; None if no id repeats, so that ids tell rows apart."""
    known = docs.where(F.col(id_col).isNotNull())
    if known.groupBy(id_col).agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        return None
    keys = known.select(F.col(id_col).alias("__id"), _digest(text_col).alias("__digest")).distinct()
    return durable(keys.repartitionByRange("__id", "__digest").sortWithinPartitions("__id", "__digest").withColumn("__row", F.monotonically_increasing_id()))


def _digest(text_col: str) -> Column:
    return F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)


def _numbered(docs: DataFrame, keys: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """docs with the column __row, null for a null id."""
    digest = spare(docs, "__text")
    told = docs.withColumn(digest, _digest(text_col))
    joined = told.join(keys, (told[id_col] == keys["__id"]) & (told[digest] == keys["__digest"]), "left")
    return joined.select(*[told[f"`{c}`"] for c in docs.columns if c != "__row"], keys["__row"])


def repeats(docs: DataFrame, min_words: int = MIN_WORDS, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, removed, start, end, other): the maximal spans of words [start, end) whose every word lies in a repeated window.

    Words are runs of `[^\x20\x09-\x0D]+`. Of equal windows the first by (id, start) is not removed (removed false), all others are; a place may lie in
    a span of either kind. `other` is a document that holds a part of the span as well, the same one if the repeat is inside it. Rows with a null
    id or text and texts shorter than min_words have no spans. Rows that share an id
    and differ in text are documents of their own; repeated rows of one id and text count once. An empty table gives no rows.
    """
    keys = _row_keys(docs, id_col, text_col)
    if keys is None:
        return _repeats(docs, min_words, gram, id_col, text_col)
    found = _repeats(_numbered(docs, keys, id_col, text_col).dropDuplicates(["__row"]), min_words, gram, "__row", text_col)
    here, there = keys.select(F.col("__row").alias("doc"), "__id"), keys.select(F.col("__row").alias("other"), F.col("__id").alias("__other"))
    return found.join(here, "doc").join(there, "other").select(F.col("__id").alias("doc"), "removed", "start", "end", F.col("__other").alias("other"))


def _repeats(docs: DataFrame, min_words: int, gram: int, id_col: str, text_col: str) -> DataFrame:
    """repeats() of rows that id_col tells apart."""
    kind = docs.schema[id_col].dataType
    told = T.StructType([T.StructField("gram", T.LongType()), T.StructField("doc", kind), T.StructField("lo", T.IntegerType()), T.StructField("hi", T.IntegerType()), *(T.StructField(k, T.BooleanType()) for k in ("first", "again", "several")), T.StructField("other", kind)])
    spans = T.StructType([T.StructField("doc", kind), T.StructField("removed", T.BooleanType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("other", kind)])
    spark = docs.sparkSession
    suffixes, at_suffixes = stored(sparse_suffixes(docs, id_col, text_col, min_words, gram))
    key = ["gram", "context", "doc", "lo"]
    pairs, at_pairs = stored(suffixes.repartitionByRange(*key).sortWithinPartitions(*key).mapInArrow(compare_neighbours, told))
    del suffixes
    release(spark, at_suffixes)
    # A k-gram that has one context only repeats as a whole; windows are needed where contexts of one k-gram differ.
    firsts = pairs.where("first")
    windows, at_windows = stored(_windows(docs, firsts.where("several"), id_col, text_col, min_words))
    release(spark)
    place = F.struct("doc", "start")
    equal = windows.groupBy("gram", "window").agg(F.min(place).alias("least"), F.max(place).alias("most"), F.max("again").alias("again")).where("again or least != most")
    met = windows.drop("again").join(equal, ["gram", "window"])
    removed = F.struct("doc", "start") != F.col("least")
    long = pairs.where("not first").select("doc", F.lit(True).alias("removed"), F.col("lo").alias("start"), (F.col("hi") + min_words).alias("end"), "other")
    alone = firsts.where("not several and again").select("doc", F.lit(False).alias("removed"), F.col("lo").alias("start"), (F.col("hi") + min_words).alias("end"), "other")
    short = met.select("doc", removed.alias("removed"), "start", (F.col("start") + min_words).cast("int").alias("end"), F.when(removed, F.col("least.doc")).otherwise(F.col("most.doc")).alias("other"))
    order = ["doc", "removed", "start"]
    found = durable(long.unionByName(alone).unionByName(short).repartition("doc").sortWithinPartitions(*order).mapInArrow(merge_spans, spans))
    del pairs, firsts, windows, equal, met, long, alone, short
    release(spark, at_pairs, at_windows)
    return found


def remove_repeats(docs: DataFrame, min_words: int = MIN_WORDS, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """The documents without their removed spans, all columns; a document of nothing else goes. `chars_col`, if there, is counted anew where a text changed.

    Rows with a null id, null, empty and short texts stay as they are. Repeated rows of one id and text are cut alike; rows that share an id and differ in text are
    documents of their own. An empty table gives no rows.
    """
    names, schema, key = docs.columns, docs.schema, id_col
    keys = _row_keys(docs, id_col, text_col)
    if keys is not None:
        docs, key = _numbered(docs, keys, id_col, text_col), "__row"
    once = docs if keys is None else docs.dropDuplicates([key])
    cuts = _repeats(once, min_words, gram, key, text_col).where("removed").groupBy(F.col("doc").alias("__doc")).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("__cuts"))
    text_at = names.index(text_col)
    chars_at = names.index(chars_col) if chars_col in names else None

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, bounds in slices(batches, text_col):
            at = rows.column(len(names))
            changed = np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False))
            columns, keep = [rows.column(i) for i in range(len(names))], np.ones(rows.num_rows, bool)
            if len(changed):
                texts, whole = columns[text_at].to_pylist(), data.tobytes()
                chars = columns[chars_at].to_pylist() if chars_at is not None else None
                _, _, first, starts, _ = doc_words(data, bounds)
                for i in changed.tolist():
                    begin, left, n = int(bounds[i]), [], int(first[i + 1] - first[i])
                    for span in at[i].as_py():
                        left.append(whole[begin : starts[first[i] + span["start"]]])
                        begin = int(starts[first[i] + span["end"]]) if span["end"] < n else int(bounds[i + 1])
                    text = b"".join([*left, whole[begin : bounds[i + 1]]]).decode()
                    texts[i], keep[i] = text, bool(text.strip())
                    if chars is not None:
                        chars[i] = len(text)
                columns[text_at] = pa.array(texts, columns[text_at].type)
                if chars is not None:
                    columns[chars_at] = pa.array(chars, columns[chars_at].type)
            yield pa.RecordBatch.from_arrays(columns, names).filter(pa.array(keep))

    joined = docs.join(cuts, docs[key] == cuts["__doc"], "left")
    return joined.select(*[docs[f"`{k}`"] for k in names], cuts["__cuts"].alias(spare(docs, "__cuts"))).mapInArrow(cut, schema)


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats(read(spark, sf_dir, "documents"))
    return found.select(F.col("doc").alias("doc_id"), "removed", F.col("start").alias("start_word"), F.col("end").alias("end_word"), (F.col("end") - F.col("start")).alias("words"), F.col("other").alias("other_doc"))
