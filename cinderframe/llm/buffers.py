"""Texts of an Arrow batch as one byte buffer, cut into words without Python strings."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

#: The white space of every word rule here: [\x20\x09-\x0D]. All are single bytes in UTF-8.
SPACES = b" \t\n\x0b\x0c\r"
IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True
#: Odd base of the rolling hash modulo 2**64, and its inverse.
BASE = 0x9E3779B97F4A7C15
BASE_INV = pow(BASE, -1, 1 << 64)
#: Bytes of text that are worked on at once; one longer text makes a slice of its own.
SLICE_BYTES = 2_000_000


def byte_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and each row's bounds in them; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(batches: Iterable[pa.RecordBatch], text: str, size: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Each batch in runs of rows of about `size` bytes: (rows, bytes, bounds)."""
    for batch in batches:
        data, bounds = byte_view(batch.column(text))
        first = 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + size, "right")) - 1)
            yield batch.slice(first, last - first), data[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first]
            first = last


def pieces(bounds: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows in runs of at most about `size` bytes, longer ones cut at multiples of it: (row of each piece, bounds of the pieces)."""
    lengths = np.diff(bounds)
    per_row = np.maximum(1, -(-lengths // size))
    row = np.repeat(np.arange(len(lengths)), per_row)
    start = bounds[:-1][row] + (np.arange(len(row)) - np.repeat(np.cumsum(per_row) - per_row, per_row)) * size
    end = np.minimum(start + size, bounds[1:][row])
    first = 0
    while first < len(row):
        last = max(first + 1, int(np.searchsorted(end, start[first] + size, "right")))
        yield row[first:last], np.r_[start[first:last], end[last - 1]]
        first = last


def word_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each run of non-space bytes; a row's end also ends a word."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~IS_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | edge[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return starts, ends, np.searchsorted(bounds, starts, "right") - 1


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i < n, modulo 2**64."""
    out = []
    for base in (BASE, BASE_INV):
        step = np.full(max(1, n), base, np.uint64)
        step[0] = 1
        out.append(np.multiply.accumulate(step, dtype=np.uint64))
    return out[0], out[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads each 64-bit number over all 64 bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of values[start:end] for each span, from one running sum."""
    up, down = powers(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def whole_groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Sorted rows in tables that split no group of equal keys. Holds one batch and one group at most."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([*held, batch]).combine_chunks()
        change = np.zeros(rows.num_rows, bool)
        for k in keys:
            x = rows.column(k).to_numpy()
            change[1:] |= x[1:] != x[:-1]
        at = np.flatnonzero(change)
        if len(at):
            yield rows.slice(0, int(at[-1]))
            held = rows.slice(int(at[-1])).to_batches()
        else:
            held = rows.to_batches()
    if held:
        yield pa.Table.from_batches(held).combine_chunks()
