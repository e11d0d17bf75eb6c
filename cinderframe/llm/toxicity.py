"""Toxicity: a learned lexicon, matched by Levenshtein automata, with context windows that tell quotation from abuse.

The lexicon is learned from labelled documents: words, and stems that take many endings, that stand in many toxic documents and in hardly any
other. All words of all texts run through one automaton, made as they go. Each hit looks at its window: hits between paired quotation marks of one line or next to
a verb of saying count as quoted. A logistic model over the counts of a document and its length gives its score.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .automaton import EXACT, FUZZY, NONE, STEM, Automaton, Entry, build
from .buffers import IS_SPACE, slices
from .tables import durable, fold, read

#: Labelled documents of each class from which the lexicon is learned, a bounded sample drawn by a hash of their id. No number of entries is fixed: each that
#: passes the next five thresholds is kept, or another one that stands for it, and none of them depends on the number of rows.
TRAIN_DOCS = 20_000
#: Toxic documents that an entry must add to those of the entries before it; how many times as frequent it must be in toxic documents as in others; and how
#: far from chance (log-likelihood ratio).
LEAST_DOCS, RATIO, EVIDENCE = 3, 15.0, 15.0
#: Fewest letters of a word that can be an entry. An entry that adds no documents of its own joins only if it stands in this share of those of the rarest
#: one that does: below it, chance companions of chosen words look like entries.
LEAST_LETTERS, LEAST_SHARE = 3, 0.5
#: Lengths of stems.
STEMS = (4, 5, 6, 7)
#: Words to either side in which a verb of saying makes a hit a quotation.
WINDOW = 4
#: The verbs, a parameter of hits() and toxicity(). Fixed values.
SAYING = ("said", "says", "wrote", "writes", "quote", "quoted", "quotes", "quoting", "called", "word", "term", "dit", "écrit", "sagte", "schrieb", "dijo", "escribió")
THRESHOLD = 0.7
KINDS = ("exact", "fuzzy", "stem", "quoted")

_CODES = 0x3000
ALNUM = np.array([chr(c).isalnum() for c in range(_CODES)])
_EDGES = "".join(chr(c) for c in [*range(33, 0x250), *range(0x2010, 0x2040)] if not chr(c).isalnum())
QUOTE = np.array(sorted(map(ord, "\"“”«»„")), np.uint32)


def words_of(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(code points, start, end, row) of the words of a slice: runs without white space, trimmed to their outer letters or digits."""
    codes = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    chars = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
    edges = chars[bounds]
    small = np.minimum(codes, _CODES - 1)
    inside = ~(IS_SPACE[np.minimum(small, 255)] & (small < 256))
    letter = ALNUM[small] | (codes >= _CODES)
    if not len(codes):
        none = np.zeros(0, np.int64)
        return codes, none, none, none
    edge = np.zeros(len(codes) + 1, bool)
    edge[edges] = True
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1] | edge[1:-1]
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    n = np.arange(len(codes))
    after = np.minimum.accumulate(np.where(letter, n, len(codes))[::-1])[::-1]
    before = np.maximum.accumulate(np.where(letter, n, -1))
    starts, ends = after[starts], before[ends - 1] + 1
    some = starts < ends
    starts, ends = starts[some], ends[some]
    return codes, starts, ends, np.searchsorted(edges, starts, "right") - 1


def _entries(text: str) -> set[tuple[str, bool]]:
    """All words of a text and their possible stems."""
    words = {w.strip(_EDGES).lower() for w in text.split()}
    words.discard("")
    return {(w, False) for w in words if len(w) >= LEAST_LETTERS} | {(w[:k], True) for w in words for k in STEMS if len(w) > k}


def _counts(texts: DataFrame, wanted: set[tuple[str, bool]] | None) -> DataFrame:
    """(entry, stem, docs) over texts, of wanted entries or all; counted in each task before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for rows in batches:
            for text in rows.column(0).to_pylist():
                found = _entries(text or "")
                seen.update(found if wanted is None else found & wanted)
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in seen], pa.string()), pa.array([k[1] for k in seen], pa.bool_()), pa.array(list(seen.values()), pa.int64())], ["entry", "stem", "docs"])

    return texts.select("text").mapInArrow(count, "entry string, stem boolean, docs long").groupBy("entry", "stem").agg(F.sum("docs").alias("docs"))


def _evidence(a: float, n: float, b: float, m: float) -> float:
    """Log-likelihood ratio of a of n against b of m."""
    rate = (a + b) / (n + m)
    term = lambda k, expected: k * math.log(k / expected) if k else 0.0
    return 2 * (term(a, n * rate) + term(b, m * rate) + term(n - a, n * (1 - rate)) + term(m - b, m * (1 - rate)))


def learn_lexicon(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> list[Entry]:
    """Entries from (id, label) rows. A bounded sample of TRAIN_DOCS documents of each label; each chosen entry covers toxic documents that none before it did."""
    drawn = [labels.where(F.col("label") == k).orderBy(F.xxhash64("id"), "id").limit(TRAIN_DOCS) for k in (0, 1)]
    sample = durable(drawn[0].unionByName(drawn[1]).select("id", F.col("label").cast("int").alias("label")))
    texts = docs.join(F.broadcast(sample), docs[id_col] == F.col("id")).select(F.col(text_col).alias("text"), "label")  # 2 * TRAIN_DOCS ids
    size = {r[0]: r[1] for r in sample.groupBy("label").count().collect()}
    if len(size) < 2:
        return []
    toxic, rest = texts.where("label = 1"), texts.where("label = 0")
    # In so few toxic documents no entry reaches EVIDENCE, were it in no other.
    least = next(a for a in range(1, size[1] + 2) if a > size[1] or _evidence(a, size[1], 0, size[0]) >= EVIDENCE)
    n = {(r.entry, r.stem): r.docs for r in _counts(toxic, None).where(F.col("docs") >= least).collect()}
    others = {(r.entry, r.stem): r.docs for r in _counts(rest, set(n)).collect()}
    clear = {k: a for k, a in n.items() if a / size[1] >= RATIO * others.get(k, 0) / size[0] and _evidence(a, size[1], others.get(k, 0), size[0]) >= EVIDENCE}
    if not clear:
        return []

    def hit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            found = [sorted(e for e in _entries(t or "") if e in clear) for t in rows.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([[("s" if s else "w") + e for e, s in f] for f in found], pa.list_(pa.string()))], ["found"])

    # At most TRAIN_DOCS lists. A chosen entry must cover documents that are not covered yet, so the words of a much copied document add nothing.
    held = toxic.select("text").mapInArrow(hit, "found array<string>").collect()
    holds = {i: {(e[1:], e[0] == "s") for e in r[0]} for i, r in enumerate(held)}
    gain = Counter(e for h in holds.values() for e in h)
    chosen: list[tuple[str, bool]] = []
    while gain:
        # Of equal gain the shortest stem, then words.
        best = max(gain, key=lambda e: (gain[e], e[1], -len(e[0]), e[0]))
        if gain[best] < LEAST_DOCS:
            break
        chosen.append(best)
        for n in [n for n, h in holds.items() if best in h]:
            gain.subtract(holds.pop(n))
    out = []
    for text, stem in chosen:
        # A stem that only ever begins one word is that word.
        whole = max((k for k in clear if not k[1] and k[0].startswith(text)), key=lambda k: (clear[k], k[0]), default=None) if stem else None
        out.append(Entry(whole[0]) if whole and clear[whole] >= 0.9 * clear[text, True] else Entry(text, stem))
    # What chosen entries cover together with others, by the same measure: clear words and the shortest clear stems from LEAST_SHARE of the rarest chosen on.
    rarest = {kind: min((clear.get((e.text, kind), 0) for e in out if e.stem is kind), default=0) for kind in (False, True)}
    more: list[Entry] = []
    for (text, stem), a in sorted(clear.items(), key=lambda x: (not x[0][1], len(x[0][0]), x[0])):
        if not rarest[stem] or a < LEAST_SHARE * rarest[stem] or any(e.stem and text.startswith(e.text) or stem and e.text.startswith(text) for e in (*out, *more)):
            continue
        more.append(Entry(text, stem))
    return sorted(set(out) | set(more), key=lambda e: (e.text, e.stem))


def hits(docs: DataFrame, lexicon: list[Entry], id_col: str = "doc_id", text_col: str = "text", saying: Sequence[str] = SAYING) -> DataFrame:
    """(id, exact, fuzzy, stem, quoted, words): abusive hits of each kind in every whole text, quoted ones of any kind, and all words; null counts as empty."""
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), *(T.StructField(k, T.IntegerType()) for k in (*KINDS, "words"))])
    terms, verbs = build(lexicon), build([Entry(w) for w in saying])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, bounds in slices(batches, "text"):
            n = rows.num_rows
            counts = _scan(terms, verbs, data, bounds) if len(data) else np.zeros((n, len(KINDS) + 1), np.int32)
            yield pa.RecordBatch.from_arrays([rows.column(0), *(pa.array(counts[:, i].astype(np.int32)) for i in range(len(KINDS) + 1))], schema.names)

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(scan, schema)


def quotations(codes: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of opening and closing marks of each quotation: two neighbouring marks of one line and one text, the first opening and the second closing.

    A mark opens if white space or a bracket stands before it and none after it, and closes otherwise; so an inch sign or a lone mark quotes nothing. The forms
    of one direction go by it, and « and » by the space inside them.
    """
    at = np.flatnonzero(np.isin(codes, QUOTE))
    if len(at) < 2:
        return at[:0], at[:0]
    row = np.searchsorted(edges, at, "right") - 1
    blank = np.zeros(256, bool)
    blank[: len(IS_SPACE)] = IS_SPACE
    space = lambda i: blank[np.minimum(codes[i], 255)] & (codes[i] < 256)
    first, last = at == edges[row], at + 1 == edges[row + 1]
    before = first | space(np.maximum(at - 1, 0)) | np.isin(codes[np.maximum(at - 1, 0)], [40, 91, 123])
    after = last | space(np.minimum(at + 1, len(codes) - 1))
    mark = codes[at]
    opens = before & ~after
    opens = np.where(mark == ord("„"), True, np.where(mark == ord("”"), False, opens))
    opens = np.where(mark == ord("«"), before, np.where(mark == ord("»"), before & ~after, opens))
    line = np.r_[0, np.cumsum(codes == 10)][at]
    pair = np.flatnonzero(opens[:-1] & ~opens[1:] & (row[1:] == row[:-1]) & (line[1:] == line[:-1]))
    return at[pair], at[pair + 1]


def _scan(terms: Automaton, verbs: Automaton, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    codes, starts, ends, row = words_of(data, bounds)
    n = len(bounds) - 1
    found = terms.run(codes, starts, ends)
    at = np.flatnonzero(found != NONE)
    quoted = np.zeros(len(at), bool)
    if len(at):
        opening, closing = quotations(codes, np.r_[0, np.cumsum((data & 0xC0) != 0x80)][bounds])
        if len(opening):
            left = np.searchsorted(opening, starts[at], "right") - 1
            quoted = (left >= 0) & (starts[at] < closing[np.maximum(left, 0)])
        near = at[:, None] + np.r_[-WINDOW:0, 1 : WINDOW + 1]
        real = (near >= 0) & (near < len(starts))
        near = np.clip(near, 0, max(0, len(starts) - 1))
        real &= row[near] == row[at][:, None]
        which = np.unique(near[real])
        says = np.zeros(len(starts), bool)
        says[which] = verbs.run(codes, starts[which], ends[which]) == EXACT
        quoted |= (says[near] & real).any(axis=1)
    kind = np.where(quoted, 3, np.select([found[at] == EXACT, found[at] == FUZZY], [0, 1], 2))
    assert len(KINDS) == 4 and STEM == 3
    return np.concatenate([np.bincount(row[at] * 4 + kind, minlength=4 * n).reshape(-1, 4), np.bincount(row, minlength=n)[:, None]], axis=1)


def _level(column: str) -> Column:
    """A count as 0, 1, 2, 3, 4 ... for 0, 1, 2-3, 4-7, 8-15 ...: every count weighs, and there are 32 levels at most."""
    return F.floor(F.log2(F.col(column) + 1)).cast("int")


def _inputs(levels: np.ndarray) -> np.ndarray:
    return np.concatenate([np.ones((len(levels), 1)), levels, levels[:, : len(KINDS)] > 0], axis=1).astype(float)


def fit(found: DataFrame, labels: DataFrame, steps: int = 60, penalty: float = 0.1) -> np.ndarray:
    """Logistic weights from (id, label) rows by Newton's method; the driver gets a row for each combination of five levels and label that occurs."""
    few = [_level(k).alias(k) for k in (*KINDS, "words")]
    cells = found.join(labels.where("label is not null"), "id").select(*few, F.col("label").cast("int").alias("label")).groupBy(*KINDS, "words", "label").count().collect()
    w = np.zeros(2 + 2 * len(KINDS))
    x, y, n = _inputs(np.array([r[:5] for r in cells]).reshape(-1, 5)), np.array([r[5] for r in cells], float), np.array([r[6] for r in cells], float)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-x @ w))
        hessian = (x * (n * p * (1 - p))[:, None]).T @ x + penalty * np.eye(len(w))
        w = w + np.linalg.solve(hessian, x.T @ (n * (y - p)) - penalty * w)
    return w


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", saying: Sequence[str] = SAYING) -> DataFrame:
    """(id, score, exact, fuzzy, stem, quoted, words) for each row of docs: how likely label 1 is. `labels` has columns id and label 0 or 1; nulls take no part.

    Without both labels nothing is learned and every score is the labels' share, 0.5 without any. Null and empty texts are texts without
    hits. Repeated rows get a row each, an empty table none; other columns are not read.
    """
    labels = labels.where("label is not null and id is not null")
    known = {r[0]: r[1] for r in labels.groupBy("label").count().collect()}
    found = durable(hits(docs, learn_lexicon(docs, labels, id_col, text_col), id_col, text_col, saying))
    if len(known) < 2:
        score = F.lit(float(next(iter(known), 0.5)))
    else:
        w = fit(found, labels)
        z = F.lit(float(w[0]))
        for i, k in enumerate((*KINDS, "words")):
            z = z + _level(k) * float(w[1 + i])
        for i, k in enumerate(KINDS):
            z = z + (F.col(k) > 0).cast("int") * float(w[2 + len(KINDS) + i])
        score = 1 / (1 + F.exp(-z))
    return found.select(F.col("id").alias(id_col), score.alias("score"), *KINDS, "words")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read(spark, sf_dir, "labels").where(fold("doc_id", 3).isin(0, 2)).select(F.col("doc_id").alias("id"), F.col("toxic").alias("label"))
    out = toxicity(read(spark, sf_dir, "documents"), labels)
    return out.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
