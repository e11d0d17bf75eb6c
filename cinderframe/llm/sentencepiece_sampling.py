"""SentencePiece encoding and decoding, and sampled segmentations without replacement.

All segmentations of a text form a lattice over its characters. A text splits at its white space, across which no piece goes, and the edges at a character depend on
the rest of its chunk only, so a node is made once for each distinct rest of a chunk of a slice. Every segmentation has a perturbed log-probability, its log-probability plus Gumbel noise; the k largest are a
sample without replacement. An A-star search finds them from the top without looking at the rest: the best of a set of segmentations
is drawn with its key, and what is left of the set is split by the first edge that differs, each part with the key of its own best. Parts
wait in a frontier; the one with the largest key is next. All texts of a slice are searched together.
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

from .buffers import BASE, mix, powers, slices, span_hashes
from .tables import read

#: The vocabulary file; a parameter of every operator here.
MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
#: Segmentations drawn for each text.
SAMPLES = 3
#: Bytes of text searched together, and the code point that stands for a space.
SLICE, MARK = 1_000_000, 0x2581
SLOTS = 20
#: Log-probabilities are summed in units of its inverse: exact for texts of some 10**8 characters.
FIXED = 2.0**32
#: Bits of a uniform number.
BITS = 52


@dataclass
class Vocabulary:
    """What sampling needs of a model: log-weights of pieces by id, a hash table of the pieces' code points, and the ids of bytes."""

    weights: np.ndarray
    hashes: np.ndarray
    ids: np.ndarray
    prefixes: np.ndarray
    longest: int
    first_byte: int
    unknown: int
    prefix: bool
    proto: bytes

    def lookup(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """slot[hash's upper bits]: number of the piece there (-1: none); numbers of pieces that found their slot taken; which slots a proper prefix of a piece has."""
        slot, late = np.full(1 << SLOTS, -1, np.int32), []
        for i, at in enumerate((self.hashes >> np.uint64(64 - SLOTS)).tolist()):
            if slot[at] < 0:
                slot[at] = i
            else:
                late.append(i)
        longer = np.zeros(1 << SLOTS, bool)
        longer[self.prefixes >> np.uint64(64 - SLOTS)] = True
        return slot, np.array(late, np.int64), longer


def vocabulary(model_file: str = MODEL_FILE) -> Vocabulary:
    """Reads a model whose normaliser is the identity. BPE models rank their pieces only; a piece then weighs as Zipf's law has it for its rank."""
    from sentencepiece import sentencepiece_model_pb2

    with open(model_file, "rb") as f:
        proto = f.read()
    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(proto)
    if model.normalizer_spec.name != "identity" or model.normalizer_spec.remove_extra_whitespaces:
        raise ValueError("only models that leave the text as it is are sampled from")
    n = len(model.pieces)
    score = np.array([p.score for p in model.pieces])
    if model.trainer_spec.model_type == 2:
        score = -np.log(np.minimum(-score, n) + 10.0)
    kinds = model.pieces[0]
    normal = [i for i, p in enumerate(model.pieces) if p.type in (kinds.NORMAL, kinds.USER_DEFINED)]
    if any(chr(MARK) in model.pieces[i].piece.lstrip(chr(MARK)) for i in normal):
        raise ValueError("a piece goes across white space")
    of_bytes = [i for i, p in enumerate(model.pieces) if p.type == kinds.BYTE]
    score[of_bytes] = score[normal].min()
    unknown = next(i for i, p in enumerate(model.pieces) if p.type == kinds.UNKNOWN)
    score[unknown] = score[normal].min() - 10
    codes = [np.array([ord(c) for c in model.pieces[i].piece], np.uint64) for i in normal]
    ends = np.cumsum([len(c) for c in codes])
    starts, whole = np.r_[0, ends[:-1]], np.concatenate(codes)
    hashes = span_hashes(whole, starts, ends)
    inner = np.flatnonzero(~np.isin(np.arange(len(whole)), ends - 1))  # the last character of each proper prefix
    prefixes = span_hashes(whole, starts[np.searchsorted(ends, inner, "right")], inner + 1)
    return Vocabulary(score, hashes, np.array(normal, np.int32), prefixes, max(map(len, codes)), of_bytes[0] if len(of_bytes) == 256 else -1, unknown, model.normalizer_spec.add_dummy_prefix, proto)


def representatives(hashes: np.ndarray) -> np.ndarray:
    """For each hash the index of an equal one, mostly the same for all equal ones; hashes that meet others in both tables stand for themselves."""
    out = np.arange(len(hashes))
    bits, left = min(len(hashes).bit_length() + 1, 24), out
    slot = np.empty(1 << bits, np.int32)
    for shift in (64 - bits, 64 - 2 * bits):
        h = hashes[left]
        place = (h >> np.uint64(shift)) & np.uint64((1 << bits) - 1)
        slot[place] = left
        found = slot[place]
        same = hashes[found] == h
        out[left[same]] = found[same]
        left = left[~same]
    return out


@dataclass
class Lattice:
    """Edges by node and then from the longest: ends of each node's edges, and of each edge its length, the node it leads to, its piece (-2: the character's bytes), log-probability at its node, that in units of 1 / FIXED, the log-mass of the node's other edges, and the sum of probabilities up to it in units of 2**-BITS. Node 0 is a chunk's end, which has no edges; nodes follow by their distance from it."""

    first: np.ndarray
    length: np.ndarray
    target: np.ndarray
    piece: np.ndarray
    log_p: np.ndarray
    fixed: np.ndarray
    log_rest: np.ndarray
    upto: np.ndarray


def lattice(v: Vocabulary, table: tuple[np.ndarray, np.ndarray, np.ndarray], codes: np.ndarray, ends: np.ndarray) -> tuple[Lattice, np.ndarray]:
    """The lattice and the node of each character. codes: all characters of the chunks, one after another; ends: for each character the end of its chunk."""
    n = len(codes)
    slot, late, longer = table
    order = np.argsort(v.hashes[late])
    known = v.hashes[late][order]
    up, down = powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
    left = ends - np.arange(n)
    same = representatives(mix((total[ends] - total[:-1]) * down[:-1] + left.astype(np.uint64)))
    at = np.flatnonzero(same == np.arange(n))
    far = left[at]
    nearest = np.argsort(far.astype(np.int16) if n and far.max() < 2**15 else far, kind="stable")
    begin, far = at[nearest], far[nearest]
    node = np.zeros(n + 1, np.int32)
    node[begin] = np.arange(1, len(begin) + 1)
    node[:n] = node[same]
    nodes, pieces = [], []
    alone = np.ones(len(begin) + 1, bool)
    alone[0] = False
    for k in range(1, v.longest + 1):
        at = at[left[at] >= k]
        if not len(at):
            break
        h = mix((total[at + k] - total[at]) * down[at] + np.uint64(k))
        place = h >> np.uint64(64 - SLOTS)
        found = slot[place]
        there = found >= 0
        same = there & (v.hashes[found] == h)
        nodes.append(node[at[same]])
        pieces.append(v.ids[found[same]])
        miss = np.flatnonzero(there & ~same)
        if len(late) and len(miss):
            where = np.minimum(np.searchsorted(known, h[miss]), len(known) - 1)
            hit = known[where] == h[miss]
            nodes[-1] = np.concatenate([nodes[-1], node[at[miss[hit]]]])
            pieces[-1] = np.concatenate([pieces[-1], v.ids[late[order[where[hit]]]]])
        if k == 1:
            alone[nodes[0]] = False
        at = at[longer[place]]
    alone = np.flatnonzero(alone)
    # Each node's edges side by side, the longest first: every length fills the next place of its nodes.
    parts = [(alone, 1, np.full(len(alone), -2, np.int32)), *zip(nodes, range(1, len(nodes) + 1), pieces, strict=True)]
    degree = np.zeros(len(begin) + 1, np.int64)
    for where, _, _ in parts:
        degree[where] += 1
    first = np.r_[0, np.cumsum(degree)]
    place, d = first[:-1].copy(), degree[1:]
    length, piece = np.empty(first[-1], np.uint8), np.empty(first[-1], np.int32)
    for where, k, found in reversed(parts):
        to = place[where]
        length[to], piece[to] = k, found
        place[where] = to + 1
    target = node[np.repeat(begin, d) + length]
    target[length == np.repeat(far, d)] = 0
    weight = v.weights[np.maximum(piece, 0)]
    bare = np.flatnonzero(piece == -2)
    code = codes[np.repeat(begin, d)[bare]]
    size = 1 + (code >= 0x80).astype(int) + (code >= 0x800) + (code >= 0x10000)
    weight[bare] = size * v.weights[v.first_byte] if v.first_byte >= 0 else v.weights[v.unknown]
    # Backwards from the chunks' ends, all nodes at one distance at a time: the log-sum over all ways to the end.
    beta = np.zeros(len(begin) + 1)
    log_p = np.empty(len(length))
    cut = np.r_[1, np.flatnonzero(np.diff(far)) + 2, len(begin) + 1] if len(begin) else np.zeros(1, int)
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
        d, low, high = degree[a:b], first[a], first[b]
        ways = weight[low:high] + beta[target[low:high]]
        top = np.maximum.reduceat(ways, first[a:b] - low)
        beta[a:b] = top + np.log(np.add.reduceat(np.exp(ways - np.repeat(top, d)), first[a:b] - low))
        log_p[low:high] = np.minimum(ways - np.repeat(beta[a:b], d), 0.0)
    log_p[first[:-1][degree == 1]] = 0.0
    p = np.exp(log_p)
    # The mass beside an edge: 1 - p is exact enough but for a very likely edge, where the node's others are summed in logs.
    log_rest = np.log1p(-np.minimum(p, 0.75))
    likely = np.flatnonzero(p > 0.75)
    owner = np.searchsorted(first, likely, "right") - 1
    d = degree[owner]
    log_rest[likely[d == 1]] = -np.inf
    likely, owner, d = likely[d > 1], owner[d > 1], d[d > 1]
    if len(likely):
        begin = np.cumsum(d) - d
        e = np.repeat(first[owner] - begin, d) + np.arange(d.sum())
        others = log_p[e]
        others[begin + likely - first[owner]] = -np.inf
        top = np.maximum.reduceat(others, begin)
        log_rest[likely] = top + np.log(np.add.reduceat(np.exp(others - np.repeat(top, d)), begin))
    part = np.rint(p * 2.0**BITS).astype(np.int64)
    run = np.cumsum(part)  # beyond 64 bits it begins anew, and differences stay exact
    upto = run - np.repeat((run - part)[first[1:-1]], degree[1:])
    upto[first[2:] - 1] = 2 ** (BITS + 1)  # the last edge of each node catches what rounding leaves
    return Lattice(first, length, target, piece, log_p, np.rint(log_p * FIXED).astype(np.int64), log_rest, upto), node


def uniforms(keys: np.ndarray, salt: int, at: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) that depend on a row's key, the draw and the place in the row only."""
    return fraction(mix(keys + np.uint64((salt * BASE) % 2**64) + mix(at.astype(np.uint64) + np.uint64(1))))


def fraction(x: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) from the upper bits of random ones."""
    return ((x >> np.uint64(64 - BITS)).astype(np.float64) + 0.5) / 2.0**BITS


def segment_max(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(largest value, its index) of each run of values; -inf and -1 for empty runs."""
    best, where = np.full(len(bounds) - 1, -np.inf), np.full(len(bounds) - 1, -1)
    some = np.flatnonzero(np.diff(bounds) > 0)
    if len(some):
        best[some] = np.maximum.reduceat(values, bounds[some])
        row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        hit = np.flatnonzero((values == best[row]) & (values > -np.inf))
        where[row[hit[::-1]]] = hit[::-1]
    return best, where


#: The edges of each row's path, by position: (position, edge, bounds by row).
Path = tuple[np.ndarray, np.ndarray, np.ndarray]


class Search:
    """The search over the texts of a slice: paths are drawn into an array that has at each character 1 plus the edge that begins there, 0 if none does."""

    def __init__(self, v: Vocabulary, table: tuple[np.ndarray, np.ndarray, np.ndarray], texts: np.ndarray, keys: np.ndarray, bounds: np.ndarray):
        self.codes, self.bounds = texts, bounds
        n = len(texts)
        mark = texts == MARK
        begins = np.zeros(n, bool)
        begins[bounds[:-1][np.diff(bounds) > 0]] = True
        begins[1:] |= mark[1:] & ~mark[:-1]
        self.chunk = np.flatnonzero(begins)
        end = np.r_[self.chunk[1:], n]
        kind = representatives(span_hashes(texts, self.chunk, end))
        some = np.flatnonzero(kind == np.arange(len(kind)))
        size = (end - self.chunk)[some]
        base = np.cumsum(size) - size
        chars = np.repeat(self.chunk[some] - base, size) + np.arange(size.sum())
        self.lattice, node = lattice(v, table, texts[chars], np.repeat(base + size, size))
        self.node = np.zeros(len(kind), np.int32)
        self.node[some] = node[base]
        self.node = self.node[kind]
        # What uniforms() makes of a row's key and each place in it, but for the draw.
        lengths = np.diff(bounds)
        steps = mix(np.arange(1, lengths.max(initial=0) + 1, dtype=np.uint64))
        self.noise = np.repeat(keys, lengths) + steps[np.arange(n) - np.repeat(bounds[:-1], lengths)]

    def random(self, at: np.ndarray, salt: int) -> np.ndarray:
        return mix(self.noise[at] + np.uint64((salt * BASE) % 2**64))

    def walk(self, path: np.ndarray, at: np.ndarray, node: np.ndarray, salt: int) -> None:
        """Draws edges into path from each position, whose node is given, to its chunk's end."""
        first, upto, length, target = self.lattice.first, self.lattice.upto, self.lattice.length, self.lattice.target
        while len(at):
            u = (self.random(at, salt) >> np.uint64(64 - BITS)).view(np.int64)
            edge = first[node]
            more = np.flatnonzero(upto[edge] <= u)
            while len(more):
                edge[more] += 1
                more = more[upto[edge[more]] <= u[more]]
            path[at] = edge + 1
            node = target[edge]
            go = np.flatnonzero(node > 0)
            at, node = at[go] + length[edge[go]], node[go]

    def taken(self, path: np.ndarray) -> Path:
        at = np.flatnonzero(path > 0)
        return at, path[at] - 1, np.searchsorted(at, self.bounds)

    def frontier(self, open_: Path, before: np.ndarray, rest: np.ndarray, salt: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(shortfall, fixed log-probability ahead, log-probability of each row's path): the parts that differ from the path first at each edge that is still open.

        before: the fixed log-probability of a row's path up to there; rest: the log-mass of the edges at the first place that are in no part yet (nan: all but the path's). A part's key is
        -log(exp(-key of what it was split from) + exp(shortfall)), so the least shortfall has the largest key.
        """
        at, edge, edges = open_
        # Sums of whole numbers do not depend on what else is in the slice.
        ahead = np.r_[0, np.cumsum(self.lattice.fixed[edge])]
        base = before - ahead[edges[:-1]]
        total = (ahead[edges[1:]] + base) / FIXED
        ahead = ahead[:-1] + np.repeat(base, np.diff(edges))
        log_rest = self.lattice.log_rest[edge]
        split = np.flatnonzero(~np.isnan(rest))
        log_rest[edges[split]] = rest[split]
        return np.log(-np.log(fraction(self.random(at, salt)))) - (ahead / FIXED + log_rest), ahead, total


def search(v: Vocabulary, table: tuple[np.ndarray, np.ndarray, np.ndarray], texts: np.ndarray, keys: np.ndarray, bounds: np.ndarray, k: int) -> tuple[Search, list[tuple[Path, np.ndarray, np.ndarray, np.ndarray]], np.ndarray]:
    """(search, [(path, has, log-probability, key)] for each draw, threshold): the k segmentations of largest key of each text, and the next key."""
    s = Search(v, table, texts, keys, bounds)
    rows = len(bounds) - 1
    drawn = np.zeros(len(texts), np.int32)
    s.walk(drawn, s.chunk, s.node, 0)
    path = part = s.taken(drawn)
    key = -np.log(-np.log(uniforms(keys, 1, np.zeros(rows))))
    has = np.ones(rows, bool)
    chunk_row = np.repeat(np.arange(rows), np.diff(np.searchsorted(s.chunk, bounds)))
    since, before, rest, taken = bounds[:-1].copy(), np.zeros(rows, np.int64), np.full(rows, np.nan), {}
    draws, open_ = [], []
    for draw in range(k):
        short, ahead, total = s.frontier(part, before, rest, 2 + 3 * draw)
        draws.append((path, has, total, np.where(has, key, -np.inf)))
        # Edges that were taken before at the place where this path left its part's prefix.
        open_.append([short, part[2], part, ahead, since, taken, key])
        best = [segment_max(-x[0], x[1]) for x in open_]
        with np.errstate(invalid="ignore"):
            tops = np.stack([np.where(np.isfinite(b[0]), -np.logaddexp(-x[6], -b[0]), -np.inf) for x, b in zip(open_, best, strict=True)])
        which = tops.argmax(axis=0)
        key = tops.max(axis=0)
        has = np.isfinite(key)
        if draw == k - 1:
            break
        drawn, since, before, rest, taken = np.zeros_like(drawn), bounds[:-1].copy(), np.zeros(rows, np.int64), np.full(rows, np.nan), {}
        begin, resume, node, prefixes = np.zeros(rows, np.int64), [s.chunk[:0]], [s.node[:0]], []
        for d, (short, _, (at, old, _), ahead, start, gone_before, _) in enumerate(open_):
            mine = np.flatnonzero(has & (which == d))
            if not len(mine):
                continue
            i = best[d][1][mine]
            x = at[i]
            short[i] = np.inf  # this part leaves the frontier
            u = fraction(s.random(x, 3 + 3 * draw))
            edge = np.zeros(len(mine), np.int64)
            left = np.searchsorted(s.lattice.first, old[i], "right") - 1
            for j, row in enumerate(mine.tolist()):  # a row for each text that goes on
                gone = {int(old[i[j]])} | (gone_before.get(row, set()) if start[row] == x[j] else set())
                ways = [e for e in range(s.lattice.first[left[j]], s.lattice.first[left[j] + 1]) if e not in gone]
                log_p = s.lattice.log_p[ways]
                upto = np.cumsum(np.exp(log_p - log_p.max()))
                at_way = min(int(np.searchsorted(upto, u[j] * upto[-1], "right")), len(ways) - 1)
                edge[j], taken[row] = ways[at_way], gone
                rest[row] = np.logaddexp.reduce(np.delete(log_p, at_way)) if len(ways) > 1 else -np.inf
            since[mine], before[mine], begin[mine] = x, ahead[i], x + s.lattice.length[edge]
            drawn[x] = edge + 1
            on = np.flatnonzero(s.lattice.target[edge])
            resume.append(begin[mine[on]])
            node.append(s.lattice.target[edge[on]])
            kept = bounds[:-1].copy()
            kept[mine] = x
            at, old, edges = draws[d][0]
            prefix = np.flatnonzero(at < np.repeat(kept, np.diff(edges)))
            prefixes.append((at[prefix], old[prefix]))
        later = np.flatnonzero(has[chunk_row] & (s.chunk >= begin[chunk_row]))
        s.walk(drawn, np.concatenate([*resume, s.chunk[later]]), np.concatenate([*node, s.node[later]]), 4 + 3 * draw)
        part = s.taken(drawn)
        for at, old in prefixes:
            drawn[at] = old + 1
        path = s.taken(drawn)
    return s, draws, key


def segmentations(docs: DataFrame, k: int = SAMPLES, model_file: str = MODEL_FILE, id_col: str = "doc_id", text_col: str = "text", seed: int = 0, decoded: bool = False) -> DataFrame:
    """(id, sample, log_prob, key, inclusion, pieces): k distinct segmentations of every whole text, drawn without replacement; fewer if the text has fewer.

    `key` is the perturbed log-probability, falling with `sample` from 1; `inclusion` is the probability that the segmentation's key exceeds the
    first one left out, 1 if none is. `pieces` holds its ids as little-endian 32-bit numbers. The draw depends on seed, id and text alone. With
    `decoded`, a column of that name has the text that the pieces stand for, as decode() gives it. A null or empty text has one segmentation, without pieces. Repeated rows are drawn alike; null ids share a key; an empty table gives no rows.
    """
    v = vocabulary(model_file)
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("sample", T.IntegerType()), *(T.StructField(c, T.DoubleType()) for c in ("log_prob", "key", "inclusion")), T.StructField("pieces", T.BinaryType()), *([T.StructField("decoded", T.StringType())] if decoded else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, told = v.lookup(), surfaces(v.proto) if decoded else None
        for big, data, bounds in slices(batches, "text"):
            a = 0
            while a < big.num_rows:
                b = max(a + 1, int(np.searchsorted(bounds, bounds[a] + SLICE, "right")) - 1)
                yield from drawn(table, told, big.slice(a, b - a), data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a])
                a = b

    def drawn(table: tuple[np.ndarray, np.ndarray, np.ndarray], told: pa.LargeBinaryArray | None, rows: pa.RecordBatch, data: np.ndarray, bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
        codes, edges, first_byte = marked(data, bounds, v.prefix)
        keys = rows.column(2).to_numpy().view(np.uint64)
        s, draws, after = search(v, table, codes, keys, edges, k)
        after = np.round(after, 8)
        parts: list[tuple] = [[], [], [], [], [], []]
        texts = []
        for nth, (path, has, log_prob, key) in enumerate(draws):
            live, log_prob, key = np.flatnonzero(has), np.round(log_prob, 8), np.round(key, 8)
            ids, count = piece_ids(v, s, path, data, first_byte)
            ends = np.r_[0, np.cumsum(count)][path[2]]
            packed = pa.BinaryArray.from_buffers(pa.binary(), len(has), [None, pa.py_buffer((4 * ends).astype(np.int32)), pa.py_buffer(ids.astype("<i4"))])
            if told:
                texts.append(gathered(ids, ends, told, v.prefix).take(pa.array(live)))
            with np.errstate(over="ignore"):
                inclusion = -np.expm1(-np.exp(log_prob[live] - after[live]))
            for column, x in zip(parts, (live, np.full(len(live), nth + 1, np.int32), log_prob[live], key[live], inclusion, packed.take(pa.array(live))), strict=True):
                column.append(x)
        live = np.concatenate(parts[0])
        yield pa.RecordBatch.from_arrays([rows.column(0).take(pa.array(live)), *(pa.array(np.concatenate(x)) for x in parts[1:5]), pa.concat_arrays(parts[5]), *([pa.concat_arrays(texts).cast(pa.string())] if told else [])], schema.names)

    return docs.select(F.col(id_col), F.col(text_col).alias("text"), F.xxhash64(F.col(id_col).cast("string"), F.lit(seed)).alias("__key")).mapInArrow(run, schema)


def marked(data: np.ndarray, bounds: np.ndarray, prefix: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code points, bounds, first byte of each): the texts with MARK for spaces, and before each text that is not empty if the model asks for it."""
    codes = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    starts = np.flatnonzero((data & 0xC0) != 0x80)
    edges = np.searchsorted(starts, bounds)
    codes = np.where(codes == 32, np.uint32(MARK), codes)
    if prefix:
        some = np.diff(edges) > 0
        codes, starts = np.insert(codes, edges[:-1][some], MARK), np.insert(starts, edges[:-1][some], -1)
        edges = edges + np.r_[0, np.cumsum(some)]
    return codes, edges, starts


def piece_ids(v: Vocabulary, s: Search, path: Path, data: np.ndarray, first_byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids, ids of each edge) along a path; characters without a piece are their bytes."""
    at, edge, _ = path
    ids = s.lattice.piece[edge]
    count = np.ones(len(at), np.int64)
    alone = np.flatnonzero(ids == -2)
    if not len(alone):
        return ids, count
    if v.first_byte < 0:
        ids[alone] = v.unknown
        return ids, count
    code = s.codes[at[alone]]
    count[alone] = 1 + (code >= 0x80).astype(int) + (code >= 0x800) + (code >= 0x10000)
    out = np.repeat(ids, count)
    size = count[alone]
    to = np.repeat(np.cumsum(count)[alone] - size, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    source = np.repeat(first_byte[at[alone]], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    out[to] = v.first_byte + data[np.clip(source, 0, max(0, len(data) - 1))].astype(np.int32)
    return out, count


def encode(docs: DataFrame, model_file: str = MODEL_FILE, text_col: str = "text", to: str = "pieces") -> DataFrame:
    """docs with `to`, the ids of the model's own best segmentation as array<int>; null stays null. A column of that name is replaced."""
    proto = vocabulary(model_file).proto
    kept = [c for c in docs.columns if c != to]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_proto=proto)
        for batch in batches:
            texts = batch.column(len(kept)).to_pylist()
            ids = model.encode([t or "" for t in texts], num_threads=1)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array([None if t is None else i for t, i in zip(texts, ids, strict=True)], pa.list_(pa.int32()))], [*kept, to])

    return docs.select(*[F.col(f"`{c}`") for c in kept], F.col(text_col).alias("__text")).mapInArrow(run, T.StructType([*(docs.schema[c] for c in kept), T.StructField(to, T.ArrayType(T.IntegerType()))]))


def surfaces(proto: bytes) -> pa.LargeBinaryArray:
    """What each id stands for, with a space for MARK; control pieces are empty."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(proto)
    kinds = model.pieces[0]
    told = {kinds.BYTE: lambda x: bytes([int(x[3:5], 16)]), kinds.UNKNOWN: lambda x: model.trainer_spec.unk_surface.encode(), kinds.CONTROL: lambda x: b""}
    parts = [told.get(x.type, lambda t: t.replace(chr(MARK), " ").encode())(x.piece) for x in model.pieces]
    return pa.array(parts, pa.large_binary())


def gathered(ids: np.ndarray, edges: np.ndarray, table: pa.LargeBinaryArray, prefix: bool) -> pa.Array:
    """The texts of ids[edges[i]:edges[i+1]], put together piece by piece, as large strings that are not checked to be UTF-8."""
    found = table.take(pa.array(ids))
    _, offsets, data = found.buffers()
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    bounds = np.frombuffer(offsets, np.int64)[found.offset :][edges] if len(ids) else np.zeros(len(edges), np.int64)
    if prefix:  # the space that the model puts before each text
        drop = bounds[:-1][np.diff(bounds) > 0]
        drop = drop[data[drop] == 32]
        data, bounds = np.delete(data, drop), bounds - np.searchsorted(drop, bounds)
    return pa.LargeStringArray.from_buffers(len(edges) - 1, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data.tobytes()))


def decode(rows: DataFrame, model_file: str = MODEL_FILE, pieces_col: str = "pieces", to: str = "text") -> DataFrame:
    """rows with `to`, the text of ids in array<int> or packed 32-bit numbers; null stays null. A column of that name is replaced.

    Bytes that are no UTF-8 become replacement characters, as the model's own decoder has it. Repeated rows are decoded alike; an empty table gives no rows.
    """
    v = vocabulary(model_file)
    proto, prefix = v.proto, v.prefix
    kept = [c for c in rows.columns if c != to]

    def whole(column: pa.Array, table: pa.LargeBinaryArray) -> pa.Array:
        """Texts of a column of ids; an error if some bytes are no UTF-8."""
        if pa.types.is_binary(column.type):
            filled = column.fill_null(b"")
            _, offsets, data = filled.buffers()
            edges = np.frombuffer(offsets, np.int32)[filled.offset : filled.offset + len(filled) + 1].astype(np.int64) // 4
            ids = np.frombuffer(data, "<i4") if data is not None and len(data) else np.zeros(0, np.int32)
            ids, edges = ids[edges[0] : edges[-1]], edges - edges[0]
        else:
            column_ = column.fill_null(pa.scalar([], column.type))
            ids, edges = column_.flatten().to_numpy(), np.r_[0, np.cumsum(pc.list_value_length(column_).to_numpy().astype(np.int64))]
        out = gathered(ids, edges, table, prefix)
        out.validate(full=True)
        return pc.if_else(column.is_valid(), out, pa.scalar(None, out.type)).cast(pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        table, model = surfaces(proto), sentencepiece.SentencePieceProcessor(model_proto=proto)
        for batch in batches:
            column = batch.column(len(kept))
            try:
                texts = whole(column, table)
            except pa.ArrowInvalid:
                packed = pa.types.is_binary(column.type)
                found = [None if x is None else model.decode(np.frombuffer(x, "<i4").tolist() if packed else x) for x in column.to_pylist()]
                texts = pa.array(found, pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], texts], [*kept, to])

    return rows.select(*[F.col(f"`{c}`") for c in kept], F.col(pieces_col).alias("__pieces")).mapInArrow(run, T.StructType([*(rows.schema[c] for c in kept), T.StructField(to, T.StringType())]))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The drawn segmentations, and the checksum of the text that each decodes to."""
    found = segmentations(read(spark, sf_dir, "documents"), decoded=True)
    return found.select("doc_id", "sample", "log_prob", "key", "inclusion", (F.octet_length("pieces") / 4).cast("long").alias("n_pieces"), F.crc32("pieces").alias("pieces_crc32"), F.crc32("decoded").alias("text_crc32"), "pieces")
