"""Language identification by a byte convolutional network that is trained in numpy.

A text is cut into windows of WINDOW bytes, all of them. Filters of widths 2, 3 and 4 run over byte classes, each filter is
pooled by its maximum over the window, and a softmax gives the languages' probabilities; a document's are the mean of its
windows', weighted by their letters. As a filter on one-hot bytes is a table, two neighbouring bytes are looked up at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .buffers import pieces, slices
from .tables import fold, read

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
#: About so many labelled documents of each language are drawn for training, by a hash of their id, and from each so many windows; of all languages
#: together TRAIN_ALL documents at most, dealt to them alike, so that the driver holds 80 MB of windows.
TRAIN_DOCS, TRAIN_WINDOWS, TRAIN_ALL = 500, 6, 50_000
EPOCHS, BATCH, RATE = 10, 128, 0.01
UNKNOWN = "und"
#: Bytes whose windows are held at once, a multiple of WINDOW: memory does not grow with a text.
PIECE = 1 << 21

#: Class of each byte: 0 padding, 1 space, 2 digit, 3 control, then letters without case, other ASCII and the bytes above 127.
CLASS = np.zeros(256, np.uint8)
CLASS[:32], CLASS[127] = 3, 3
CLASS[[9, 10, 11, 12, 13, 32]] = 1
CLASS[48:58] = 2
_rest = [b for b in range(33, 256) if CLASS[b] == 0 and not 65 <= b <= 90]
CLASS[_rest] = np.arange(4, 4 + len(_rest))
CLASS[65:91] = CLASS[97:123]
CLASSES = 4 + len(_rest)
ASCII_LETTER = np.zeros(256, bool)
ASCII_LETTER[65:91] = ASCII_LETTER[97:123] = True
LETTER = ASCII_LETTER.copy()
LETTER[128:] = True


def windows(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(classes, row, weight): every window of every row as byte classes, its row and its letters plus 1."""
    lengths = np.diff(bounds)
    per_row = -(-lengths // WINDOW)
    row = np.repeat(np.arange(len(lengths)), per_row)
    start = bounds[:-1][row] + (np.arange(len(row)) - np.repeat(np.cumsum(per_row) - per_row, per_row)) * WINDOW
    at = start[:, None] + np.arange(WINDOW)
    inside = at < bounds[1:][row][:, None]
    raw = data[np.minimum(at, max(0, len(data) - 1))]
    return np.where(inside, CLASS[raw], 0), row, (LETTER[raw] & inside).sum(axis=1) + 1.0


@dataclass
class ByteCNN:
    """tables[w][k]: (CLASSES, FILTERS) weights of offset k in filters of width w."""

    langs: list[str]
    tables: dict[int, np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def pairs(self) -> dict[tuple[int, int], np.ndarray]:
        """Sums of two neighbouring offsets by pair of classes."""
        return {(w, k): (t[k][:, None, :] + t[k + 1][None, :, :]).reshape(-1, FILTERS) for w, t in self.tables.items() for k in range(0, w - 1, 2)}

    def probabilities(self, x: np.ndarray, pairs: dict[tuple[int, int], np.ndarray], rows: int = 64) -> np.ndarray:
        out = np.zeros((len(x), len(self.langs)), np.float32)
        for a in range(0, len(x), rows):
            part = x[a : a + rows]
            two = part[:, :-1].astype(np.int32) * CLASSES + part[:, 1:]
            pooled = []
            for w in WIDTHS:
                n = WINDOW - w + 1
                s = pairs[w, 0][two[:, :n]]
                if w == 3:
                    s += self.tables[3][2][part[:, 2:]]
                elif w == 4:
                    s += pairs[4, 2][two[:, 2 : 2 + n]]
                pooled.append(s.max(axis=1))
            h = np.maximum(np.concatenate(pooled, axis=1) + self.bias, 0)
            z = h @ self.out + self.out_bias
            z = np.exp(z - z.max(axis=1, keepdims=True))
            out[a : a + rows] = z / z.sum(axis=1, keepdims=True)
        return out


def train(x: np.ndarray, y: np.ndarray, langs: list[str], epochs: int = EPOCHS, seed: int = 7) -> ByteCNN:
    """Fits the network to windows x of languages y (indexes into langs) by Adam on the cross-entropy, classes weighted alike."""
    rng = np.random.default_rng(seed)
    tables = {w: rng.normal(0, 0.1, (w, CLASSES, FILTERS)).astype(np.float32) for w in WIDTHS}
    hidden = FILTERS * len(WIDTHS)
    params = [*tables.values(), np.zeros(hidden, np.float32), rng.normal(0, hidden**-0.5, (hidden, len(langs))).astype(np.float32), np.zeros(len(langs), np.float32)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    weight = (len(y) / np.maximum(1, np.bincount(y, minlength=len(langs))) / len(langs))[y]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for a in range(0, len(order), BATCH):
            take = order[a : a + BATCH]
            part, target = x[take], y[take]
            pooled, best = [], []
            for table, w in zip(params, WIDTHS, strict=False):
                n = WINDOW - w + 1
                s = table[0][part[:, :n]]
                for k in range(1, w):
                    s = s + table[k][part[:, k : k + n]]
                best.append(s.argmax(axis=1))
                pooled.append(s.max(axis=1))
            pre = np.concatenate(pooled, axis=1) + params[3]
            keep = rng.random(pre.shape) < 0.8
            h = np.maximum(pre, 0) * keep / 0.8
            z = h @ params[4] + params[5]
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(target)), target] -= 1
            p *= (weight[take] / len(take))[:, None]
            back = (p @ params[4].T) * (pre > 0) * keep / 0.8
            grads = [np.zeros_like(q) for q in params]
            for i, w in enumerate(WIDTHS):
                g = back[:, i * FILTERS : (i + 1) * FILTERS]
                rows, filters = np.arange(len(part))[:, None], np.arange(FILTERS)[None, :]
                for k in range(w):
                    np.add.at(grads[i][k], (part[rows, best[i] + k], filters), g)
            grads[3], grads[4], grads[5] = back.sum(axis=0), h.T @ p, p.sum(axis=0)
            step += 1
            for q, g, m, v in zip(params, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                q -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return ByteCNN(langs, dict(zip(WIDTHS, params[:3], strict=True)), *params[3:])


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_lang: int = TRAIN_DOCS) -> ByteCNN | None:
    """A network from rows with a language whose fold of three is not 1; None if there are none.

    A bounded sample: about per_lang documents of each language (fewer where there are over TRAIN_ALL / per_lang languages), and TRAIN_WINDOWS
    windows of each, spread over the whole text. Every language is learned.
    """
    known = docs.where(F.col(lang_col).isNotNull() & (F.col(lang_col) != UNKNOWN) & (F.length(text_col) > 0) & fold(id_col, 3).isin(0, 2))
    counts = {r[0]: r[1] for r in known.groupBy(lang_col).count().collect()}  # a row for each language
    if not counts:
        return None
    langs = sorted(counts)
    per_lang = min(per_lang, max(1.0, TRAIN_ALL / len(langs)))
    share = F.create_map(*[x for k in langs for x in (F.lit(k), F.lit(per_lang / counts[k]))])
    drawn = known.where(F.pmod(F.xxhash64(id_col, F.lit(11)), F.lit(1 << 20)) / float(1 << 20) < share[F.col(lang_col)])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, bounds in slices(batches, "text"):
            x, row, _ = windows(data, bounds)
            per_row = np.bincount(row, minlength=rows.num_rows)
            first = np.cumsum(per_row) - per_row
            take = np.unique(np.concatenate([first + (per_row - 1) * k // max(1, TRAIN_WINDOWS - 1) for k in range(TRAIN_WINDOWS)])[np.tile(per_row > 0, TRAIN_WINDOWS)])
            yield pa.RecordBatch.from_arrays([pa.array([x[i].tobytes() for i in take], pa.binary()), rows.column(1).take(pa.array(row[take]))], ["window", "lang"])

    got = drawn.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).mapInArrow(cut, "window binary, lang string").collect()
    got.sort(key=lambda r: (bytes(r[0]), r[1]))  # the same model, whatever order the tasks ended in
    x = np.frombuffer(b"".join(r[0] for r in got), np.uint8).reshape(-1, WINDOW)
    number = {k: i for i, k in enumerate(langs)}
    return train(x, np.array([number[r[1]] for r in got]), langs)


def verdicts(model: ByteCNN | None, n: int, data: np.ndarray, bounds: np.ndarray, pairs: dict) -> tuple[np.ndarray, np.ndarray]:
    """(best, score) of n texts; best is 0 for `und`, else 1 plus the language's index."""
    if not model or not len(data):
        return np.zeros(n, np.int64), np.zeros(n)
    total, has = np.zeros((n, len(model.langs))), np.zeros(n, bool)
    for of, edges in pieces(bounds, PIECE):
        part = data[edges[0] : edges[-1]]
        x, row, weight = windows(part, edges - edges[0])
        np.add.at(total, of[row], model.probabilities(x, pairs) * weight[:, None])
        letters = np.r_[0, np.cumsum(ASCII_LETTER[part])]
        np.logical_or.at(has, of, letters[edges[1:] - edges[0]] > letters[edges[:-1] - edges[0]])
    total /= np.maximum(1e-9, total.sum(axis=1, keepdims=True))
    for i in np.flatnonzero(~has & (np.diff(bounds) > 0)):
        has[i] = any(map(str.isalpha, data[bounds[i] : bounds[i + 1]].tobytes().decode("utf-8", "replace")))
    return np.where(has, total.argmax(axis=1) + 1, 0), np.clip(np.where(has, total.max(axis=1), 0.0), 0.0, 1.0)


def identify(docs: DataFrame, model: ByteCNN | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every whole text: `und` with score 0 for null, texts without a letter, or no model.

    Repeated rows get a row each; other columns are not read; an empty table gives no rows.
    """
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def make(rows: pa.RecordBatch, best: np.ndarray, score: np.ndarray, names: np.ndarray) -> tuple[list, None]:
        return [rows.column(0), pa.array(names[best], pa.string()), pa.array(score)], None

    return _judged(docs.select(F.col(id_col), F.col(text_col).alias("text")), model, "text", make, schema)


def least_score(docs: DataFrame, model: ByteCNN | None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> float:
    """The largest score, in hundredths, below which verdicts on held-out documents are wrong more often than right; 0 if there is none.

    From every labelled document whose fold of three is 1.
    """
    known = docs.where(F.col(lang_col).isNotNull() & (F.col(lang_col) != UNKNOWN) & (F.length(text_col) > 0) & (fold(id_col, 3) == 1)).select(id_col, text_col, lang_col)
    told = _judged(known.select(id_col, text_col, F.col(lang_col).alias("__lang")), model, text_col, lambda batch, best, score, names: ([batch.column(2), pa.array(names[best], pa.string()), pa.array(score)], None), "lang string, pred string, score double")
    levels = told.where(F.col("pred") != UNKNOWN).groupBy(F.floor(F.col("score") * 100).alias("level")).agg(F.count("*").alias("n"), F.sum((F.col("lang") == F.col("pred")).cast("int")).alias("right")).orderBy("level").collect()  # 101 rows at most
    least, n, right = 0.0, 0, 0
    for r in levels:
        n, right = n + r["n"], right + r["right"]
        if 2 * right < n:
            least = (r["level"] + 1) / 100
    return least


def _judged(docs: DataFrame, model: ByteCNN | None, text_col: str, make, schema: T.StructType | str) -> DataFrame:
    """make(rows, best, score, names) for every slice of docs: columns and the rows to keep (None: all)."""
    names = [f.name for f in (schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, langs = model.pairs() if model else {}, np.array([UNKNOWN, *(model.langs if model else [])], object)
        for rows, data, bounds in slices(batches, text_col):
            columns, keep = make(rows, *verdicts(model, rows.num_rows, data, bounds, pairs), langs)
            out = pa.RecordBatch.from_arrays(columns, names)
            yield out if keep is None else out.filter(pa.array(keep))

    return docs.mapInArrow(run, schema)


def drop_unknown(docs: DataFrame, least: float | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Documents with a language, all columns: `und` ones go, and those whose best language scores under `least` (None: least_score()).

    A null language becomes the predicted one; a given one stays. The verdict is made where the row is, so nothing is shuffled. Null ids and repeated rows
    are judged like any other; null and empty texts go; without a labelled document to learn from every document goes. An empty table gives no rows.
    """
    model = learn(docs, id_col, text_col, lang_col)
    least = least_score(docs, model, id_col, text_col, lang_col) if least is None else least
    at = docs.columns.index(lang_col)

    def make(rows: pa.RecordBatch, best: np.ndarray, score: np.ndarray, names: np.ndarray) -> tuple[list, np.ndarray]:
        columns = list(rows.columns)
        columns[at] = pc.coalesce(columns[at], pa.array(names[best], pa.string()).cast(columns[at].type))
        return columns, (best > 0) & (score >= least)

    return _judged(docs, model, text_col, make, docs.schema)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = identify(docs, learn(docs))
    return found.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")
