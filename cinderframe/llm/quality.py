"""Quality scores: random Fourier features of document statistics, ridge regression, isotonic calibration.

A Gaussian kernel over standardised statistics is approximated by COSINES random cosines. Each partition sums its share of the normal
equations for each of FOLDS parts of the training rows; the driver solves one small system. Scores of rows that a system did not
see are calibrated by pooling adjacent violators over fixed bins of the score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .buffers import slices, span_hashes, word_spans
from .tables import durable, fold, read

COSINES, SIGMA, RIDGE, SEED = 160, 3.0, 1e-3, 17
FOLDS = 5
#: Training rows of one partial sum of the normal equations.
ROWS_PER_SUM = 50_000
#: Bins of the raw score for calibration, over this range.
BINS, LOW, HIGH = 400, -0.5, 1.5
THRESHOLD = 0.3

#: Byte classes whose shares are statistics.
CLASSES = ("lower", "upper", "digit", "space", "newline", "stop", "shout", "symbol", "bar", "quote", "other", "high")
CLASS = np.full(256, CLASSES.index("other"), np.uint8)
for _name, _bytes in (("lower", range(97, 123)), ("upper", range(65, 91)), ("digit", range(48, 58)), ("space", b" \t\r\x0b\x0c"), ("newline", b"\n"), ("stop", b".,;:"), ("shout", b"!?"), ("symbol", b"#$%&*@^~+=<>\\/_"), ("bar", b"|"), ("quote", b"\"'`()[]{}"), ("high", range(128, 256))):
    CLASS[list(_bytes)] = CLASSES.index(_name)
STATISTICS = (*CLASSES, "bytes", "words", "word_bytes", "longest", "distinct_words", "distinct_lines", "upper_of_letters", "marked_words")


def statistics_of(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(rows, STATISTICS) of texts: shares of byte classes, logarithms of counts, and shares of distinct words and lines."""
    n, size = len(bounds) - 1, np.diff(bounds)
    row = np.repeat(np.arange(n), size)
    counts = np.bincount(row * len(CLASSES) + CLASS[data], minlength=n * len(CLASSES)).reshape(n, -1)
    starts, ends, of = word_spans(data, bounds)
    words = np.bincount(of, minlength=n)

    def distinct(of: np.ndarray, hashes: np.ndarray, total: np.ndarray) -> np.ndarray:
        order = np.lexsort((hashes, of))
        new = np.r_[True, (of[order][1:] != of[order][:-1]) | (hashes[order][1:] != hashes[order][:-1])] if len(order) else np.zeros(0, bool)
        return np.bincount(of[order][new], minlength=n) / np.maximum(1, total)

    longest = np.zeros(n)
    np.maximum.at(longest, of, ends - starts)
    breaks = np.flatnonzero(data == 10)
    line_starts = np.unique(np.r_[bounds[:-1][size > 0], breaks + 1])
    line_starts = line_starts[line_starts < len(data)]
    line_row = np.searchsorted(bounds, line_starts, "right") - 1
    line_ends = np.r_[line_starts[1:], len(data)]
    lines = np.bincount(line_row, minlength=n)
    kinds = CLASS[data]
    odd = np.r_[0, np.cumsum((kinds == CLASSES.index("symbol")) | (kinds == CLASSES.index("shout")))]
    marked = np.bincount(of[odd[ends] > odd[starts]], minlength=n)
    some = np.maximum(1, size)
    letters = counts[:, 0] + counts[:, 1]
    columns = [*(counts / some[:, None]).T, np.log1p(size), np.log1p(words), np.log1p((ends - starts).sum() and np.bincount(of, ends - starts, minlength=n) / np.maximum(1, words)), np.log1p(longest)]
    columns += [distinct(of, span_hashes(data, starts, ends), words), distinct(line_row, span_hashes(data, line_starts, line_ends), lines), counts[:, 1] / np.maximum(1, letters), marked / np.maximum(1, words)]
    return np.stack([np.broadcast_to(c, n) for c in columns], axis=1).astype(np.float64)


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, and a double for each of STATISTICS) of every whole text; null counts as empty."""
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), *(T.StructField(k, T.DoubleType()) for k in STATISTICS)])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, bounds in slices(batches, "text"):
            x = statistics_of(data, bounds)
            yield pa.RecordBatch.from_arrays([rows.column(0), *(pa.array(x[:, i]) for i in range(x.shape[1]))], schema.names)

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(scan, schema)


@dataclass
class Ridge:
    """Standardising, the random cosines, weights (one row for each fold left out, and the last for none) and calibration."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray | None = None
    levels: np.ndarray | None = None
    prior: float = 0.5

    def cosines(self, x: np.ndarray) -> np.ndarray:
        rng = np.random.default_rng(SEED)
        w, b = rng.normal(0, 1 / SIGMA, (x.shape[1], COSINES)), rng.uniform(0, 2 * np.pi, COSINES)
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.concatenate([np.sqrt(2 / COSINES) * np.cos(z @ w + b), np.ones((len(x), 1))], axis=1)

    def calibrated(self, raw: np.ndarray) -> np.ndarray:
        """The level of the raw score; a thousandth of the raw score itself keeps the order within a level."""
        centres = LOW + (np.arange(BINS) + 0.5) * (HIGH - LOW) / BINS
        return np.clip(0.998 * np.interp(raw, centres, self.levels) + 0.002 * np.clip(raw, 0, 1), 0, 1)


def pooled(positive: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Isotonic levels of bins by pooling adjacent violators; bins without rows are interpolated."""
    blocks: list[list[float]] = []
    for i in np.flatnonzero(count):
        blocks.append([positive[i], count[i], i, i])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [blocks[-1][0] + last[0], blocks[-1][1] + last[1], blocks[-1][2], last[3]]
    at = np.array([x for b in blocks for x in (b[2], b[3])])
    level = np.array([b[0] / b[1] for b in blocks for _ in range(2)])
    return np.interp(np.arange(len(count)), at, level)


def fit(stats: DataFrame, labels: DataFrame) -> Ridge:
    """A model from (id, label 0/1) rows; nulls take no part. Without both labels its score is their share, or 0.5."""
    means = stats.agg(*[F.avg(k) for k in STATISTICS], *[F.stddev_pop(k) for k in STATISTICS]).first()
    x = np.array([0.0 if v is None else v for v in means], float)
    model = Ridge(x[: len(STATISTICS)], np.maximum(1e-6, x[len(STATISTICS) :]))
    part = F.pmod(F.xxhash64("id", F.lit(5)), F.lit(FOLDS)).cast("int").alias("part")
    known = durable(stats.join(labels.where("label is not null"), "id").select(part, F.col("label").cast("double").alias("label"), *STATISTICS))
    seen = {r[0]: r[1] for r in known.groupBy("label").count().collect()}
    total = sum(seen.values())
    if len(seen) < 2:
        model.prior = next(iter(seen), 0.5)
        return model
    model.prior = seen.get(1.0, 0) / total
    n = COSINES + 1

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((FOLDS, n, n + 1))
        for rows in batches:
            f, y = rows.column(0).to_numpy(), rows.column(1).to_numpy()
            z = model.cosines(np.stack([rows.column(2 + i).to_numpy() for i in range(len(STATISTICS))], axis=1))
            for k in range(FOLDS):
                out[k] += z[f == k].T @ np.c_[z[f == k], y[f == k]]
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(FOLDS), n)), pa.array(np.tile(np.arange(n), FOLDS)), pa.array(list(out.reshape(-1, n + 1)), pa.list_(pa.float64()))], ["part", "line", "terms"])

    def add(lines: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(k, g["line"].iloc[0], np.sum(np.stack(g["terms"]), axis=0)) for k, g in lines.groupby("part")], columns=["part", "line", "terms"])

    partial = known.repartition(max(1, total // ROWS_PER_SUM)).mapInArrow(sums, "part long, line long, terms array<double>")
    got = partial.groupBy("line").applyInPandas(add, "part long, line long, terms array<double>").collect()
    system = np.zeros((FOLDS, n, n + 1))
    for r in got:
        system[r[0], r[1]] = r[2]

    def solved(s: np.ndarray) -> np.ndarray:
        return np.linalg.solve(s[:, :n] + RIDGE * max(1.0, np.trace(s[:, :n])) / n * np.eye(n), s[:, n])

    whole = system.sum(axis=0)
    model.weights = np.stack([*(solved(whole - s) for s in system), solved(whole)])

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            z = model.cosines(np.stack([rows.column(2 + i).to_numpy() for i in range(len(STATISTICS))], axis=1))
            raw = (z * model.weights[rows.column(0).to_numpy()]).sum(axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(np.clip((raw - LOW) / (HIGH - LOW) * BINS, 0, BINS - 1).astype(np.int64)), rows.column(1)], ["bin", "label"])

    held = known.mapInArrow(bins, "bin long, label double").groupBy("bin").agg(F.sum("label"), F.count("*")).collect()
    positive, count = np.zeros(BINS), np.zeros(BINS)
    for r in held:
        positive[r[0]], count[r[0]] = r[1], r[2]
    model.levels = pooled(positive, count)
    return model


def scores(stats: DataFrame, model: Ridge) -> DataFrame:
    """(id, score) of every row of statistics()."""
    schema = T.StructType([stats.schema["id"], T.StructField("score", T.DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            if model.weights is None:
                out = np.full(rows.num_rows, model.prior)
            else:
                x = np.stack([rows.column(1 + i).to_numpy() for i in range(len(STATISTICS))], axis=1)
                out = model.calibrated(model.cosines(x) @ model.weights[-1])
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(out)], ["id", "score"])

    return stats.select("id", *STATISTICS).mapInArrow(score, schema)


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) for each row of docs: how likely label 1 is. `labels` has columns id and label.

    Null and empty texts are scored by their statistics, which are all 0. Repeated rows get a row each, an empty table none; other columns are not read.
    """
    stats = durable(statistics(docs, id_col, text_col))
    return scores(stats, fit(stats, labels)).withColumnRenamed("id", id_col)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read(spark, sf_dir, "labels").where(fold("doc_id", 5) > 0).select(F.col("doc_id").alias("id"), F.col("quality").alias("label"))
    out = quality(read(spark, sf_dir, "documents"), labels)
    return out.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
