"""Places and running sums of rows within their key, without a task that holds a key's rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import durable


def _runs(column: pa.Array) -> tuple[np.ndarray, np.ndarray, list]:
    """First row and length of each run of equal values, and the first and last value; nulls are equal."""
    values = column.fill_null(0).to_numpy(zero_copy_only=False)
    none = column.is_null().to_numpy(zero_copy_only=False)
    first = np.flatnonzero(np.r_[True, (values[1:] != values[:-1]) | (none[1:] != none[:-1])])
    return first, np.diff(np.r_[first, len(values)]), [None if none[i] else int(values[i]) for i in first[[0, -1]]]


def positions(df: DataFrame, key: str, *order: str, to: str = "pos", sums: tuple[str, ...] = ()) -> DataFrame:
    """df with `to`: each row's place from 0 among the rows of its key, a long, in ascending `order`, nulls first; `sums` become running sums modulo 2**64 of columns of longs without nulls.

    Rows are sorted in ranges over key and order, so a key with a third of all rows is spread over as many tasks; what a range must know of
    those before it is a count and its sums, and the driver sees a row for each range. Rows that are equal in key and order may swap places.
    """
    keys = [F.col(c).asc_nulls_first() for c in (key, *order)]
    placed = durable(df.repartitionByRange(*keys).sortWithinPartitions(*keys))
    at, of = placed.columns.index(key), [placed.columns.index(c) for c in sums]

    def counted(batch: pa.RecordBatch) -> np.ndarray:
        return np.column_stack([np.ones(batch.num_rows, np.uint64), *[batch.column(i).to_numpy().view(np.uint64) for i in of]])

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What the range's first and last key hold in it."""
        head, tail, runs = None, None, 0
        n_head = n_tail = np.zeros(1 + len(of), np.uint64)
        for batch in batches:
            if not batch.num_rows:
                continue
            first, _, (a, b) = _runs(batch.column(at))
            held = np.add.reduceat(counted(batch), first, axis=0)
            goes_on = runs > 0 and a == tail
            if runs == 0:
                head, n_head = a, held[0]
            elif goes_on and runs == 1:
                n_head = n_head + held[0]
            n_tail = held[-1] + n_tail if goes_on and len(first) == 1 else held[-1]
            tail, runs = b, runs + len(first) - goes_on
        if runs:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([head], pa.int64()), pa.array([n_head.view(np.int64)]), pa.array([tail], pa.int64()), pa.array([n_tail.view(np.int64)]), pa.array([runs == 1])], ["part", "head", "n_head", "tail", "n_tail", "one"])

    ahead: dict[int, np.ndarray] = {}
    before, carried = (), np.zeros(1 + len(of), np.uint64)
    for r in sorted(placed.mapInArrow(ends, "part int, head long, n_head array<long>, tail long, n_tail array<long>, one boolean").collect(), key=lambda r: r.part):
        ahead[r.part] = carried if before == (r.head,) else np.zeros_like(carried)
        before, carried = (r.tail,), (ahead[r.part] + np.array(r.n_head, np.int64).view(np.uint64) if r.one else np.array(r.n_tail, np.int64).view(np.uint64))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail, gone = (), ahead.get(TaskContext.get().partitionId())
        for batch in batches:
            if not batch.num_rows:
                continue
            first, length, (a, b) = _runs(batch.column(at))
            one = counted(batch)
            total = np.cumsum(one, axis=0, dtype=np.uint64)
            offset = total[first] - one[first]
            if tail in ((), (a,)):
                offset[0] -= gone
            total -= np.repeat(offset, length, axis=0)
            tail, gone = (b,), total[-1]
            columns = list(batch.columns)
            for k, i in enumerate(of):
                columns[i] = pa.array(np.ascontiguousarray(total[:, k + 1]).view(np.int64))
            yield pa.RecordBatch.from_arrays([*columns, pa.array((total[:, 0] - np.uint64(1)).astype(np.int64))], [*batch.schema.names, to])

    return placed.mapInArrow(place, T.StructType([*placed.schema.fields, T.StructField(to, T.LongType())]))
