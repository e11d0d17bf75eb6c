"""A hierarchical Pitman-Yor language model over words: a restaurant for each preceding word, all with the restaurant of single words as their parent.

Texts become slices of word numbers, kept once. Each slice's pairs of neighbouring words go to buckets by the second word's hash (pairs of the most frequent second words by
both, so that no bucket holds a hot word's pairs alone). A bucket seats the customers of its pairs, and, for the words that it owns, those of the parent, whose customers are the
pairs' tables. A pair seen once has one table whatever is drawn, so only the others are seated: in each round every customer of each pair leaves its
table and sits down again by the restaurant's rule (a Gibbs sweep), and so does every customer of the parent. Between rounds buckets exchange what they need of each other's words: tables by
context, and the parent's probabilities. The predictive probabilities of the rounds after BURN_IN are averaged; every slice gets those of its pairs and adds them up.
"""

from __future__ import annotations

import json
import math
import random
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .buffers import mix, slices, span_hashes, word_spans
from .tables import fold, read, release, stored

#: Discount and strength of the restaurants of contexts and of their parent.
DISCOUNT, STRENGTH = 0.75, 1.0
ROOT_DISCOUNT, ROOT_STRENGTH = 0.6, 10.0
#: Rounds, those of them that are not averaged, and sweeps of all customers in a round.
ROUNDS, BURN_IN, SWEEPS = 3, 1, 1
#: Dishes whose tables a task holds as lists at once.
DISHES = 65_536
#: Words that stand for a text's end and beginning.
END, BEGIN = np.uint64(0x5E4D), np.uint64(0xBE61)
#: Bytes of text in a slice and in what is hashed at once, tokens for each bucket, and the share of tokens from which a word's pairs are dealt by both words: at most 1024 words.
SLICE, HASHED, BUCKET_TOKENS, HOT_SHARE = 6_000_000, 500_000, 3_000_000, 1024
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

ROW = "bucket int, kind string, src long, i binary, x binary, y binary, z binary, data binary"


def pack(**arrays: np.ndarray) -> bytes:
    """Named arrays as one compressed value."""
    names, flat = list(arrays), [np.ascontiguousarray(x) for x in arrays.values()]
    head = json.dumps([(n, x.dtype.str, x.shape) for n, x in zip(names, flat, strict=True)]).encode()
    body = b"".join([len(head).to_bytes(4, "little"), head, *[x.tobytes() for x in flat]])
    return len(body).to_bytes(8, "little") + pa.compress(body, "zstd", asbytes=True)


def unpack(data: bytes) -> dict[str, np.ndarray]:
    body = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)
    at = 4 + int.from_bytes(body[:4], "little")
    out = {}
    for name, kind, shape in json.loads(body[4:at]):
        out[name] = np.frombuffer(body, kind, math.prod(shape), at).reshape(shape)
        at += out[name].nbytes
    return out


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values, and each value's place among them; by hash, which beats a sort of all."""
    codes, found = pd.factorize(values)
    order = np.argsort(found)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return found[order], place[codes]


def _flat(column: pa.ChunkedArray, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """Values and lengths of a column of binary stretches of an array."""
    held = [np.frombuffer(v.as_buffer(), kind) for v in column]
    return np.concatenate(held) if held else np.zeros(0, kind), np.array([len(h) for h in held], np.int64)


def numbered_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of rows (id, held_out, text): their distinct words, and the texts as numbers of these. The last word stands for a text's beginning."""
    count = 0
    for rows, data, bounds in slices(batches, "text", SLICE):
        parts, lengths = [], []
        first = 0
        while first < rows.num_rows:  # the hashes of a whole slice at once would take many times its bytes
            last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + HASHED, "right")) - 1)
            text, cuts = LOWER[data[bounds[first] : bounds[last]]], bounds[first : last + 1] - bounds[first]
            start, end, row = word_spans(text, cuts)
            tokens = np.full(len(start) + last - first, END, np.uint64)
            tokens[np.arange(len(start)) + row] = span_hashes(text, start, end)
            parts.append(tokens)
            lengths.append(np.bincount(row, minlength=last - first) + 1)  # each text's end is a token
            first = last
        tokens, upto = np.concatenate(parts), np.r_[0, np.cumsum(np.concatenate(lengths))]
        words, numbers = distinct(tokens)
        often = np.argsort(-np.bincount(numbers), kind="stable")  # small numbers for frequent words, in two halves, pack well
        rank = np.empty(len(often), np.int64)
        rank[often] = np.arange(len(often))
        words, numbers = words[often], rank[numbers]
        held = rows.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
        packed = pack(words=np.r_[words, BEGIN], low=(numbers & 0xFFFF).astype(np.uint16), high=(numbers >> 16).astype(np.uint16), upto=upto, held=held)
        yield pa.RecordBatch.from_arrays([pa.array([(TaskContext.get().partitionId() << 32) + count]), pa.ListArray.from_arrays(pa.array([0, rows.num_rows], pa.int32()), rows.column("id")), pa.array([packed], pa.binary()), pa.array([int(upto[-1])])], ["slice", "ids", "data", "n"])
        count += 1


def _owner(words: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(words) % np.uint64(buckets)).astype(np.int64)


def _numbers(s: dict[str, np.ndarray]) -> np.ndarray:
    return s["low"].astype(np.int64) + (s["high"].astype(np.int64) << 16)


class Pairs:
    """The distinct pairs of a slice in the order of their buckets, and within one by second and first word."""

    def __init__(self, data: bytes, buckets: int, hot: np.ndarray):
        s = unpack(data)
        self.words, tokens, upto, self.held = s["words"], _numbers(s), s["upto"], s["held"]
        self.upto, w = upto, len(self.words)
        before = np.r_[w - 1, tokens[:-1]]
        before[upto[:-1]] = w - 1
        key, self.pair_of = distinct(tokens * w + before)
        second, first = np.divmod(key, w)
        train = np.repeat(~self.held, np.diff(upto))
        n = np.bincount(self.pair_of, weights=train, minlength=len(key))
        self.own = _owner(self.words, buckets)
        at = self.own[second]
        is_hot = np.isin(self.words, hot, kind="sort")[second] if len(hot) else np.zeros(len(second), bool)
        at[is_hot] = _owner(self.words[first[is_hot]] * np.uint64(3) + self.words[second[is_hot]], buckets)
        order = np.argsort(at, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.pair_of, self.tokens = place[self.pair_of], tokens
        self.first, self.second, self.n, self.at = first[order], second[order], n[order].astype(np.int64), at[order]
        # The words that each bucket is told of: those it owns, and those of its pairs.
        listed = np.unique(np.r_[self.own * w + np.arange(w), self.at * w + self.second])
        self.list_bucket, self.list_word = np.divmod(listed, w)
        self.buckets = np.unique(self.list_bucket)
        self.list_bounds = np.searchsorted(self.list_bucket, np.r_[self.buckets, buckets])
        self.bounds = np.searchsorted(self.at, np.r_[self.buckets, buckets])


def _asks(buckets: int, hot: np.ndarray) -> Callable:
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, data in zip(batch.column("slice").to_pylist(), batch.column("data"), strict=True):
                p = Pairs(data.as_py(), buckets, hot)
                told = []
                for k in range(len(p.buckets)):
                    pairs, listed = slice(p.bounds[k], p.bounds[k + 1]), p.list_word[p.list_bounds[k] : p.list_bounds[k + 1]]
                    firsts, index = distinct(p.first[pairs])
                    runs = np.bincount(np.searchsorted(listed, p.second[pairs]), minlength=len(listed))
                    told.append(pack(words=p.words[listed], runs=runs.astype(np.uint32), firsts=p.words[firsts], first=index.astype(np.uint32), n=p.n[pairs].astype(np.uint32)))
                yield pa.RecordBatch.from_arrays([pa.array(p.buckets, pa.int32()), pa.array(np.full(len(p.buckets), number)), pa.array(told, pa.binary())], ["bucket", "slice", "data"])

    return ask


def _message(bucket: int, kind: str, src: int, i=(), x=(), y=(), z=(), data: bytes | None = None) -> tuple:
    return bucket, kind, src, np.asarray(i, np.uint64).tobytes(), *[np.asarray(v, float).tobytes() for v in (x, y, z)], data


SCHEMA = pa.schema([("bucket", pa.int32()), ("kind", pa.string()), ("src", pa.int64()), *[(k, pa.binary()) for k in ("i", "x", "y", "z", "data")]])


def _rows(messages: list[tuple]) -> pa.Table:
    return pa.Table.from_arrays([pa.array(list(column), field.type) for column, field in zip(zip(*messages, strict=True), SCHEMA, strict=True)], schema=SCHEMA)


def _dealt(words: np.ndarray, buckets: int, kind: str, src: int, **values: np.ndarray) -> list[tuple]:
    """Messages about words to their owners; words come sorted by owner."""
    at = _owner(words, buckets)
    cuts = np.flatnonzero(np.r_[True, at[1:] != at[:-1], True]) if len(at) else []
    return [_message(int(at[a]), kind, src, words[a:b], **{k: v[a:b] for k, v in values.items()}) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _opened(buckets: int) -> Callable:
    """Counts a bucket's pairs: its state with every customer of a pair at one table, how the slices' pairs are found in it, and what others must know."""

    def begin(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        told = [unpack(d.as_py()) for d in table.column("data")]
        words, place = distinct(np.concatenate([t["words"] for t in told]))
        second = np.repeat(place, np.concatenate([t["runs"] for t in told]))
        first, n = np.concatenate([t["firsts"][t["first"]] for t in told]), np.concatenate([t["n"] for t in told])
        lengths, n_pairs = (np.array([len(t[k]) for t in told]) for k in ("words", "first"))
        pair, found = pd.factorize(mix(first * np.uint64(3) + mix(words[second])))
        at = np.empty(len(found), np.int64)
        at[pair] = np.arange(len(pair))
        c = np.bincount(pair, weights=n, minlength=len(at)).astype(np.int64)
        several, once = np.flatnonzero(c > 1), np.flatnonzero(c == 1)
        code = np.minimum(c, 1)
        code[several] = 2 + np.arange(len(several))
        out = []
        pair_cuts, word_cuts = np.r_[0, np.cumsum(n_pairs)], np.r_[0, np.cumsum(lengths)]
        for k, number in enumerate(table.column("slice").to_pylist()):
            held = pack(code=code[pair[pair_cuts[k] : pair_cuts[k + 1]]].astype(np.uint32), word=place[word_cuts[k] : word_cuts[k + 1]].astype(np.uint32))
            out.append(_message(bucket, "codes", number, data=held))
        count = np.bincount(second, weights=n, minlength=len(words))
        single = np.bincount(second[at[once]], minlength=len(words)).astype(float)
        own = _owner(words, buckets) == bucket
        contexts, tables = np.unique(first[at[once]], return_counts=True)
        by, away = np.argsort(_owner(contexts, buckets), kind="stable"), np.flatnonzero(~own)
        away = away[np.argsort(_owner(words[away], buckets), kind="stable")]
        asked = np.unique(np.r_[first[at[several]], words[~own]])
        asked = asked[np.argsort(_owner(asked, buckets), kind="stable")]
        find = np.argsort(asked)
        first_asked = find[np.searchsorted(asked[find], first[at[several]])]
        word_asked = np.full(len(words), -1)
        word_asked[~own] = find[np.searchsorted(asked[find], words[~own])]
        small = {k: v.astype(np.int32) for k, v in {"u": first_asked, "w": second[at[several]], "t": np.ones(len(several)), "tables": np.zeros(len(several)), "word_asked": word_asked}.items()}
        state = pack(words=words, own=own, count=count, single=single, sizes=c[several], asked=asked, **small)
        out += _dealt(contexts[by], buckets, "sum", bucket, x=tables[by]) + _dealt(words[away], buckets, "away", bucket, y=count[away], z=single[away]) + _dealt(asked, buckets, "ask", bucket)
        return _rows([*out, _message(bucket, "state", bucket, data=state)])

    return begin


def _swept(n: list[int], customers: int, new: float, discount: float, sweeps: int, rand: Callable[[], float]) -> list[int]:
    """Tables n of one dish after it has come to have so many customers and every one of them has left and sat down again in each sweep.

    A customer sits down at the table of another one, drawn until one is accepted, or at a new one. A table of n others so has weight n - discount.
    """
    at = [k for k, size in enumerate(n) for _ in range(size)]
    free: list[int] = []
    while len(at) > customers:  # any of them leaves, as they are exchangeable
        j = int(rand() * len(at))
        k, at[j] = at[j], at[-1]
        at.pop()
        n[k] -= 1
        if not n[k]:
            free.append(k)
    some = len(at)
    at += [-1] * (customers - some)
    for first, others in [(some, None)] + [(0, customers - 1)] * sweeps:  # who is new meets those before them, then everyone meets all others
        for j in range(first, customers):
            m = j if others is None else others
            k = at[j]
            if k >= 0:
                n[k] -= 1
                if not n[k]:
                    free.append(k)
            span = m + new
            while True:
                r = rand() * span
                if r >= m:
                    if free:
                        k = free.pop()
                    else:
                        k = len(n)
                        n.append(0)
                    break
                i = int(r)
                k = at[i if i < j else i + 1]
                if (r - i) * n[k] >= discount:
                    break
            n[k] += 1
            at[j] = k
    return [size for size in n if size] if free else n


def reseat(sizes: np.ndarray, t: np.ndarray, new: np.ndarray, discount: float, sweeps: int, draw: np.random.Generator, customers: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Tables of several dishes after Gibbs sweeps, in each of which every customer of every dish leaves and sits down again, at a table of n others with weight n - discount, or at a new one with weight `new`.

    sizes: the tables of all dishes, one dish after the other; t: tables of each dish; customers: those that each dish is to have, if they have changed. Before the sweeps who is too many leaves, and who is new sits down by the same rule.
    """
    rand = random.Random(int(draw.integers(2**62))).random
    ends = np.cumsum(t)
    if customers is None:
        total = np.r_[0, np.cumsum(sizes)]
        customers = total[ends] - total[ends - t]
    kept, tables = [], []
    for a in range(0, len(t), DISHES):  # so many as lists at once
        block = slice(a, a + DISHES)
        held = sizes[ends[a] - t[a] : ends[block][-1]].tolist()
        out, of, first = array("i"), array("i"), 0
        for count, want, weight in zip(t[block].tolist(), customers[block].tolist(), new[block].tolist(), strict=True):
            n = held[first : first + count]
            first += count
            if want > 2:
                n = _swept(n, want, weight, discount, sweeps, rand)
            elif want == 2:  # the last to move finds the other one alone, wherever both were
                n = [2] if rand() * (1 - discount + weight) < 1 - discount else [1, 1]
            else:  # one customer has one table whatever is drawn
                n = [1] * want
            out.extend(n)
            of.append(len(n))
        kept.append(np.array(out, np.int32))
        tables.append(np.array(of, np.int32))
    return (np.concatenate(kept), np.concatenate(tables)) if kept else (sizes, t)


def _root_tables(s: dict[str, np.ndarray], customers: np.ndarray, weight: float, draw: np.random.Generator) -> np.ndarray:
    """Tables of each word at the parent, after its number of customers has changed and all of them have been seated again."""
    sizes, t = s.get("root_sizes", np.zeros(0, np.int32)), s.get("root_t", np.zeros(len(customers), np.int32))
    s["root_sizes"], s["root_t"] = reseat(sizes, t, np.full(len(t), weight), ROOT_DISCOUNT, SWEEPS, draw, customers.astype(np.int64))
    return s["root_t"]


def _round(buckets: int, number: int, totals: dict[str, float]) -> Callable:
    """One round of a bucket: takes in what others told, seats its pairs' and its words' customers, and tells the others. Round 0 gathers counts, round 1 only answers."""

    def step(table: pa.Table) -> pa.Table:
        kinds = np.array(table.column("kind").to_pylist())
        rows = {k: table.take(np.flatnonzero(kinds == k)) for k in ("state", "sum", "away", "ask", "reply")}
        bucket, s = table.column("bucket")[0].as_py(), unpack(rows["state"].column("data")[0].as_py())
        words, own = s["words"], s["own"]
        draw = np.random.default_rng([bucket, number])
        context, away = np.zeros(len(words)), np.zeros(len(words))
        if rows["sum"].num_rows:
            context = np.bincount(np.searchsorted(words, _flat(rows["sum"].column("i"), np.uint64)[0]), weights=_flat(rows["sum"].column("x"), float)[0], minlength=len(words))
        if rows["away"].num_rows:
            at = np.searchsorted(words, _flat(rows["away"].column("i"), np.uint64)[0])
            away = np.bincount(at, weights=_flat(rows["away"].column("z"), float)[0], minlength=len(words))
            if number == 0:
                s["count"] = s["count"] + np.bincount(at, weights=_flat(rows["away"].column("y"), float)[0], minlength=len(words))
                s["single"], away = s["single"] + away, np.zeros(len(words))
        local = np.bincount(s["w"], weights=s["t"], minlength=len(words))
        out = []
        if number == 0:
            s["context"] = context
            order = np.argsort(rows["ask"].column("src").to_numpy())
            asks = rows["ask"].take(order)
            s["ask_src"] = asks.column("src").to_numpy()
            asked, s["ask_n"] = _flat(asks.column("i"), np.uint64)
            s["ask_at"] = np.searchsorted(words, asked).astype(np.int32)
        customers = np.where(own, s["single"] + local + away, 0.0)
        if number > 0:
            p0 = 1 / (totals["V"] + 1)
            weight = ROOT_STRENGTH + ROOT_DISCOUNT * totals["T0"]
            t0 = _root_tables(s, customers, weight * p0, draw)
            p = (customers - ROOT_DISCOUNT * t0 + weight * p0) / (ROOT_STRENGTH + totals["C0"])
            opened = s["context"] + context
            cuts = np.r_[0, np.cumsum(s["ask_n"])]
            for k, src in enumerate(s["ask_src"]):
                at = s["ask_at"][cuts[k] : cuts[k + 1]]
                out.append(_message(int(src), "reply", bucket, x=opened[at], y=p[at]))
            if number > 1 + BURN_IN:  # all of one seating: pairs' tables, contexts' sums of them, and the parent's customers
                s[f"seated{number}"], s[f"opened{number}"] = (customers - ROOT_DISCOUNT * t0).astype(np.float32), opened.astype(np.float32)
                s["tables"] = s["tables"] + s["t"]
        if 1 < number < 1 + ROUNDS:
            replies = rows["reply"].take(np.argsort(rows["reply"].column("src").to_numpy()))
            opened_of, p_of = (_flat(replies.column(k), float)[0] for k in "xy")
            of = np.where(own, p, p_of[s["word_asked"]] if len(p_of) else 0.0)
            s["sizes"], s["t"] = reseat(s["sizes"], s["t"], (STRENGTH + DISCOUNT * opened_of[s["u"]]) * of[s["w"]], DISCOUNT, SWEEPS, draw)
        if number < 1 + ROUNDS:
            here = np.flatnonzero(~own)
            here = here[np.argsort(_owner(words[here], buckets), kind="stable")]
            out += _dealt(s["asked"], buckets, "sum", bucket, x=np.bincount(s["u"], weights=s["t"], minlength=len(s["asked"])))
            out += _dealt(words[here], buckets, "away", bucket, z=np.bincount(s["w"], weights=s["t"], minlength=len(words))[here])
        sums = [s["count"][own].sum(), (own & (s["count"] > 0)).sum(), customers.sum(), s["root_t"].sum() if "root_t" in s else 0]
        out.append(_message(bucket, "total", bucket, x=sums))
        return _rows([*out, _message(bucket, "state", bucket, data=pack(**s))])

    return step


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The buckets' totals of a batch."""
    for batch in batches:
        sums = sum((np.frombuffer(v.as_buffer()) for v in batch.column("x")), np.zeros(4))
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in sums], ["N", "V", "C0", "T0"])


def _answers(kept: dict[int, tuple[float, float]], v: float) -> Callable:
    """What a bucket tells each slice: of its pairs customers less discounted tables, of its words counts, and for each averaged round tables as a context and the parent's probability. kept: customers and tables of the whole parent in these rounds."""

    def answer(table: pa.Table) -> pa.Table:
        kinds = table.column("kind").to_pylist()
        s = unpack(table.column("data")[kinds.index("state")].as_py())
        bucket = table.column("bucket")[0].as_py()
        total, ends = np.r_[0, np.cumsum(s["sizes"])], np.cumsum(s["t"])
        value = np.r_[0.0, 1 - DISCOUNT, total[ends] - total[ends - s["t"]] - DISCOUNT * s["tables"] / len(kept)].astype(np.float32)
        opened = np.stack([s[f"opened{n}"] for n in kept], axis=1).astype(np.float32)
        p = np.stack([(s[f"seated{n}"] + (ROOT_STRENGTH + ROOT_DISCOUNT * t) / (v + 1)) / (ROOT_STRENGTH + c) for n, (c, t) in kept.items()], axis=1).astype(np.float32)
        out = []
        for k, number, data in zip(kinds, table.column("src").to_pylist(), table.column("data"), strict=True):
            if k == "codes":
                held = unpack(data.as_py())
                out.append((number, bucket, pack(pair=value[held["code"]], count=s["count"][held["word"]].astype(np.uint32), opened=opened[held["word"]], p=p[held["word"]])))
        schema = pa.schema([("slice", pa.int64()), ("bucket", pa.int32()), ("ids", pa.list_(pa.int64())), ("data", pa.binary())])
        return pa.Table.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int32()), pa.nulls(len(out), pa.list_(pa.int64())), pa.array([o[2] for o in out], pa.binary())], schema=schema)

    return answer


def _scores(buckets: int, hot: np.ndarray, totals: dict[str, float]) -> Callable:
    def score(table: pa.Table) -> pa.Table:
        mine = table.column("bucket").to_pylist().index(-1)
        p = Pairs(table.column("data")[mine].as_py(), buckets, hot)
        value, count = np.zeros(len(p.first)), np.zeros(len(p.words))
        rounds = ROUNDS - BURN_IN
        opened, root = np.zeros((len(p.words), rounds)), np.zeros((len(p.words), rounds))
        at = {b: k for k, b in enumerate(p.buckets.tolist())}
        for bucket, data in zip(table.column("bucket").to_pylist(), table.column("data"), strict=True):
            if bucket < 0:
                continue
            told, k = unpack(data.as_py()), at[bucket]
            value[p.bounds[k] : p.bounds[k + 1]] = told["pair"]
            listed = p.list_word[p.list_bounds[k] : p.list_bounds[k + 1]]
            own = p.own[listed] == bucket
            count[listed[own]], opened[listed[own]], root[listed[own]] = told["count"][own], told["opened"][own], told["p"][own]
        customers = count.copy()
        customers[-1] = totals["texts"]  # each training text begins once
        below = ((STRENGTH + DISCOUNT * opened[p.first]) * root[p.second]).mean(axis=1)
        log = np.log10((value + below) / (STRENGTH + customers[p.first]))
        starts, n = p.upto[:-1], np.diff(p.upto)
        base = np.log10((count + 1) / (totals["N"] + totals["V"] + 1))
        known = count > 0
        columns = [pa.array(n), pa.array(np.add.reduceat(known[p.tokens].astype(np.int64), starts)), pa.array(np.full(len(n), int(totals["N"]))), pa.array(np.add.reduceat(base[p.tokens], starts)), pa.array(np.add.reduceat(log[p.pair_of], starts))]
        return pa.Table.from_arrays([table.column("ids").chunk(0)[mine].values if table.column("ids").num_chunks == 1 else table.column("ids").combine_chunks()[mine].values, pa.array(p.held), *columns], ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return score


def scored(docs: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text", bucket_tokens: int = BUCKET_TOKENS) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each row of docs, learned from the rows for which the condition held_out is false.

    Words are runs of other than white space with A-Z lower-cased; a text's end is a token as well. score is the log10 probability of all tokens under the averaged model, base_score under counts plus
    one. Null text is empty, repeated rows count and are scored each, a null id is kept; without rows there are none, and without training rows every token is
    equally likely. Other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), held_out.alias("held_out"), F.col(text_col).alias("text"))
    texts, _ = stored(rows.mapInArrow(numbered_texts, "slice long, ids array<long>, data binary, n long"))
    size = texts.agg(F.sum("n")).first()[0]
    schema = f"id {docs.schema[id_col].dataType.simpleString()}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    if size is None:
        return spark.createDataFrame([], schema)
    buckets = max(4, -(-size // bucket_tokens))

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("data"):
                s = unpack(data.as_py())
                n = np.bincount(_numbers(s), minlength=len(s["words"]))
                often = np.flatnonzero(n * 2 * HOT_SHARE > n.sum())
                yield pa.RecordBatch.from_arrays([pa.array(s["words"][often].view(np.int64)), pa.array(n[often])], ["word", "n"])

    often = texts.select("data").mapInArrow(frequent, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") * HOT_SHARE > size)
    hot = np.array([r.word for r in often.orderBy("word").collect()], np.int64).view(np.uint64)
    asks = texts.select("slice", "data").mapInArrow(_asks(buckets, hot), "bucket int, slice long, data binary")
    state, path = stored(asks.groupBy("bucket").applyInArrow(_opened(buckets), ROW))
    codes, codes_path = state.where("kind = 'codes'"), path
    release(spark)
    totals: dict[str, float] = {}
    kept: dict[int, tuple[float, float]] = {}
    for number in range(2 + ROUNDS):
        state, new = stored(state.where("kind not in ('codes', 'total')").groupBy("bucket").applyInArrow(_round(buckets, number, dict(totals)), ROW))
        sums = state.where("kind = 'total'").select("x").mapInArrow(_summed, "N double, V double, C0 double, T0 double").agg(*[F.sum(k).alias(k) for k in ("N", "V", "C0", "T0")]).first()
        totals |= {"N": sums.N, "V": sums.V, "C0": sums.C0, "T0": sums.T0 or sums.V}
        if number > 1 + BURN_IN:
            kept[number] = sums.C0, sums.T0
        release(spark, *([path] if number else []))
        path = new
    counted = rows.agg(F.count_if(~F.col("held_out"))).first()
    totals["texts"] = counted[0]
    both = state.where("kind = 'state'").unionByName(codes)
    told, _ = stored(both.groupBy("bucket").applyInArrow(_answers(kept, totals["V"]), "slice long, bucket int, ids array<long>, data binary"))
    del state, both, codes
    release(spark, path, codes_path)
    whole = texts.select("slice", F.lit(-1).alias("bucket"), "ids", "data").unionByName(told)
    return whole.groupBy("slice").applyInArrow(_scores(buckets, hot, totals), schema)


def op12_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores all `documents`; those whose crc32(doc_id as text) mod 7 is 2 are held out. A null doc_id is not."""
    out = scored(read(spark, sf_dir, "documents"), fold("doc_id", 7) == 2)
    return out.withColumnRenamed("id", "doc_id")
