"""The boundary of the union of a few simple polygons, for the polygons of very many keys at once."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Pairs of edges that are weighed at once, in some thirty arrays of 8 bytes each.
PAIRS = 1 << 16


def _ragged(first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(i, j): for each i, all j from first[i] to first[i] + n[i] - 1."""
    i = np.repeat(np.arange(len(n)), n)
    return i, np.arange(len(i)) + np.repeat(first - (np.cumsum(n) - n), n)


def _on_segment(px, py, x1, y1, x2, y2, near: float) -> np.ndarray:
    """Whether points lie within a squared distance of segments."""
    dx, dy = x2 - x1, y2 - y1
    t = np.clip(((px - x1) * dx + (py - y1) * dy) / (dx * dx + dy * dy), 0.0, 1.0)
    return (px - (x1 + t * dx)) ** 2 + (py - (y1 + t * dy)) ** 2 <= near


def _cuts(x1, y1, x2, y2, i: np.ndarray, j: np.ndarray, digits: int) -> list[tuple]:
    """(edge, x, y) lists: where edges i and j cross or touch, on each of the two."""
    least = 10.0**-digits
    for lo, hi in ((np.minimum(x1, x2), np.maximum(x1, x2)), (np.minimum(y1, y2), np.maximum(y1, y2))):
        beside = (lo[i] <= hi[j] + least) & (lo[j] <= hi[i] + least)
        i, j = i[beside], j[beside]
    a, b = (x1[i], y1[i], x2[i], y2[i]), (x1[j], y1[j], x2[j], y2[j])
    found, met = [], np.zeros(len(i), bool)
    for own, at, s, p in ((i, a, a, b), (j, b, b, a)):
        for k in (0, 2):
            on = _on_segment(p[k], p[k + 1], *s, 10.0 ** (-2 * digits))
            met |= on
            found.append((own[on], p[k][on], p[k + 1][on]))
    free = ~met
    i, j, a, b = i[free], j[free], [v[free] for v in a], [v[free] for v in b]
    ax, ay, bx, by, gx, gy = a[2] - a[0], a[3] - a[1], b[2] - b[0], b[3] - b[1], b[0] - a[0], b[1] - a[1]
    turn = ax * by - ay * bx
    t, u = (gx * by - gy * bx) / turn, (gx * ay - gy * ax) / turn
    cross = (turn != 0) & (t >= 0) & (t <= 1) & (u >= 0) & (u <= 1)
    x, y = np.round(a[0] + t * ax, digits)[cross] + 0.0, np.round(a[1] + t * ay, digits)[cross] + 0.0
    return [*found, (i[cross], x, y), (j[cross], x, y)]


def _same(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, starts): rows in an order in which equal ones are neighbours, and where each run of equal ones begins."""
    mixed = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        mixed = (mixed ^ c.view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    order = np.argsort(mixed)
    change = lambda: np.logical_or.reduce([c[order][1:] != c[order][:-1] for c in columns])
    differ = change()
    if (differ & (mixed[order][1:] == mixed[order][:-1])).any():  # different rows with one hash
        order = np.lexsort(columns)
        differ = change()
    return order, np.flatnonzero(np.concatenate([[True], differ]))


def union_edges(x: np.ndarray, y: np.ndarray, starts: np.ndarray, group: np.ndarray, digits: int) -> tuple[np.ndarray, ...]:
    """(group, x1, y1, x2, y2) of the boundaries of all groups' unions, by the rules of union_boundary().

    x, y: the corners of all polygons, one ring of three points or more each; `starts` their first corners and the number of corners; `group` each polygon's, in ascending order.
    """
    sizes, last = np.diff(starts), group.max() + 1
    of, after = np.repeat(np.arange(len(sizes)), sizes), np.arange(1, len(x) + 1)
    after[starts[1:] - 1] = starts[:-1]
    raw = x, y, x[after], y[after]
    back = ~(np.add.reduceat(raw[0] * raw[3] - raw[2] * raw[1], starts[:-1]) > 0)[of]
    x1, y1, x2, y2 = [np.round(np.where(back, raw[(k + 2) % 4], raw[k]), digits) + 0.0 for k in range(4)]
    some = (x1 != x2) | (y1 != y2)
    x1, y1, x2, y2, part = x1[some], y1[some], x2[some], y2[some], of[some]
    if not len(x1):
        return (group[:0], x1, y1, x2, y2)

    # Each edge meets those of the later polygons of its group.
    group_of = group[part]
    ends = np.searchsorted(part, np.arange(len(sizes)), "right")[part], np.searchsorted(group_of, np.arange(last), "right")[group_of]
    n = np.arange(len(x1))
    cuts = _cuts(x1, y1, x2, y2, *_ragged(ends[0], ends[1] - ends[0]), digits)
    edge, px, py = (np.concatenate(c) for c in zip((n, x1, y1), (n, x2, y2), *cuts))
    along = (px - x1[edge]) * (x2 - x1)[edge] + (py - y1[edge]) * (y2 - y1)[edge]
    order = np.lexsort((py, px, along, edge))
    edge, px, py = edge[order], px[order], py[order]
    new = np.concatenate([[True], (edge[1:] != edge[:-1]) | (px[1:] != px[:-1]) | (py[1:] != py[:-1])])
    edge, px, py = edge[new], px[new], py[new]

    # Pieces of edges, and lines, which are equal pieces whichever way they run.
    k = np.flatnonzero(edge[1:] == edge[:-1])
    piece_of, p, q = part[edge[k]], (px[k], py[k]), (px[k + 1], py[k + 1])
    ahead = (p[0] < q[0]) | ((p[0] == q[0]) & (p[1] < q[1]))
    low, high = [np.where(ahead, a, b) for a, b in zip(p, q)], [np.where(ahead, b, a) for a, b in zip(p, q)]
    order, begin = _same(group[piece_of].astype(np.int64), *low, *high)
    any_ahead, any_back = np.logical_or.reduceat(ahead[order], begin), np.logical_or.reduceat(~ahead[order], begin)
    line_of = np.empty(len(order), np.int64)
    line_of[order] = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(order))))
    head = order[begin]
    line_group, low, high = group[piece_of[head]], [v[head] for v in low], [v[head] for v in high]
    kept = ~(any_ahead & any_back)

    # A line is hidden by a polygon that it is no piece of, if its middle lies strictly within.
    first = np.searchsorted(group, np.arange(last))
    many = np.where(kept, np.bincount(group, minlength=last)[line_group], 0)
    line, polygon = _ragged(first[line_group], many)
    place = np.cumsum(many) - many
    others = np.ones(len(line), bool)
    whole = kept[line_of]
    others[place[line_of[whole]] + piece_of[whole] - first[group[piece_of[whole]]]] = False
    mx, my = (low[0] + high[0]) / 2, (low[1] + high[1]) / 2
    line, polygon = line[others], polygon[others]
    for m, v in ((mx, x), (my, y)):
        near = (m[line] >= np.minimum.reduceat(v, starts[:-1])[polygon]) & (m[line] <= np.maximum.reduceat(v, starts[:-1])[polygon])
        line, polygon = line[near], polygon[near]
    if len(line):
        pair, e = _ragged(starts[:-1][polygon], sizes[polygon])
        ex1, ey1, ex2, ey2, hx, hy = *[v[e] for v in raw], mx[line][pair], my[line][pair]
        dx, dy, gx, gy = ex2 - ex1, ey2 - ey1, hx - ex1, hy - ey1
        on = (dx * gy == dy * gx) & (hx >= np.minimum(ex1, ex2)) & (hx <= np.maximum(ex1, ex2)) & (hy >= np.minimum(ey1, ey2)) & (hy <= np.maximum(ey1, ey2))
        crossed = ((ey1 > hy) != (ey2 > hy)) & (hx < dx * gy / dy + ex1)
        at = np.cumsum(sizes[polygon]) - sizes[polygon]
        within = (np.add.reduceat(crossed.astype(np.int64), at) % 2 == 1) & ~np.logical_or.reduceat(on, at)
        kept[line[within]] = False
    start, stop = [np.where(any_ahead, a, b) for a, b in zip(low, high)], [np.where(any_ahead, b, a) for a, b in zip(low, high)]
    return line_group[kept], start[0][kept], start[1][kept], stop[0][kept], stop[1][kept]


def boundaries(digits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For mapInArrow: (key, xs, ys) of polygons in order of keys to (key, x1, y1, x2, y2). A key's polygons are held together, so they should be few."""

    def unions(rows: pa.RecordBatch, code: np.ndarray) -> Iterator[pa.RecordBatch]:
        xs, ys = rows.column(1), rows.column(2)
        x, y = xs.flatten().to_numpy(), ys.flatten().to_numpy()
        sizes = np.diff(xs.offsets.to_numpy())
        starts = np.concatenate([[0], np.cumsum(sizes)])
        heads = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
        room = np.cumsum(np.add.reduceat(sizes, heads).astype(np.int64) ** 2) // PAIRS
        cut = np.append(heads[np.flatnonzero(np.concatenate([[True], room[1:] != room[:-1]]))], len(code))
        for a, b in zip(cut[:-1], cut[1:]):
            part = slice(starts[a], starts[b])
            with np.errstate(divide="ignore", invalid="ignore"):
                group = code[a:b] - code[a]
                got = union_edges(x[part], y[part], starts[a : b + 1] - starts[a], group, digits)
            key = rows.column(0).slice(a, b - a).take(pa.array(np.searchsorted(group, got[0])))
            yield pa.RecordBatch.from_arrays([key, *[pa.array(v) for v in got[1:]]], names=[rows.schema.names[0], "x1", "y1", "x2", "y2"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            held = batch if held is None else pa.concat_batches([held, batch])
            code = held.column(0).dictionary_encode().indices.to_numpy()
            whole = int(np.searchsorted(code, code[-1]))  # the last key may go on in the next batch
            if whole:
                yield from unions(held.slice(0, whole), code[:whole])
                held = held.slice(whole)
        if held is not None:
            yield from unions(held, held.column(0).dictionary_encode().indices.to_numpy())

    return run
