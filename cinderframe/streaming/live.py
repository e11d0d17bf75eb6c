"""Streams: hotspots, log lines and weather as they come in. Each function takes a streaming DataFrame; batch frames work alike."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQueryListener
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, MapState, TimerValues

from ..operators.runlog import COMPLETED, ERROR_LINE, LAST_STEP, STEP, TRACEBACK, case_state, step_number


def chains(hotspots: DataFrame, gap: str = "7 days", late: str = "1 day") -> DataFrame:
    """(case_id, chain_start, chain_end, n) of each closed chain: gaps up to `gap`, the gap itself included, do not break it."""
    sessions = hotspots.withWatermark("sat_ts", late).groupBy("case_id", F.session_window("sat_ts", gap).alias("w"))
    return sessions.agg(F.count("*").alias("n"), F.min("sat_ts").alias("chain_start"), F.max("sat_ts").alias("chain_end")).select("case_id", "chain_start", "chain_end", "n")


#: Covered cells are kept as bits of square tiles of so many cells a side.
TILE = 64


class _Cover(StatefulProcessor):
    """Keeps the cells of a case's open chains: a row of bits for each tile and span of one gap, in which all times belong to one chain. A timer closes a chain."""

    def __init__(self, radius: float, cell: float, gap: int):
        self.radius, self.cell, self.gap = radius, cell, gap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.spans = handle.getListState("spans", "span long, first long, last long")  # read and written in one call each
        self.tiles = handle.getMapState("tiles", "span long, tu long, tv long", "bits binary")

    def _cells(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of the place, row and column of each cell of the discs around all places."""
        steps = np.arange(int(2 * self.radius / self.cell) + 2)
        u, v = (np.floor((k - self.radius) / self.cell).astype(np.int64)[:, None] + steps for k in (x, y))
        dx, dy = (u + 0.5) * self.cell - x[:, None], (v + 0.5) * self.cell - y[:, None]
        which, i, j = np.nonzero(dx[:, :, None] ** 2 + dy[:, None, :] ** 2 <= self.radius * self.radius)
        return which, u[which, i], v[which, j]

    def _add(self, us: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
        known = self._known()
        span, after = us // self.gap, dict(known)
        for n in np.unique(span):
            times = us[span == n]
            old = known.get(int(n), (times[0], times[0]))
            after[int(n)] = (min(int(times.min()), int(old[0])), max(int(times.max()), int(old[1])))
        if after != known:
            self.spans.put([(n, *times) for n, times in after.items()])
        which, u, v = self._cells(x, y)
        at = np.stack([span[which], u // TILE, v // TILE])
        order = np.lexsort(at)
        at, bit = at[:, order], (u % TILE * TILE + v % TILE)[order]
        cuts = np.nonzero((at[:, 1:] != at[:, :-1]).any(axis=0))[0] + 1
        for first, last in zip([0, *cuts], [*cuts, len(bit)], strict=True):
            if first == last:
                continue
            key = tuple(int(k) for k in at[:, first])
            held = self.tiles.getValue(key) if key[0] in known else None
            bits = np.zeros(TILE * TILE, np.uint8)
            bits[bit[first:last]] = 1
            packed = np.packbits(bits)
            self.tiles.updateValue(key, ((packed if held is None else packed | np.frombuffer(bytes(held[0]), np.uint8)).tobytes(),))

    def _known(self) -> dict[int, tuple[int, int]]:
        """First and last time of each span."""
        return {int(n): (int(first), int(last)) for n, first, last in self.spans.get()} if self.spans.exists() else {}

    def _chains(self) -> list[tuple[int, int, list[int]]]:
        """(first, last, spans) of the open chains, in order."""
        out: list[tuple[int, int, list[int]]] = []
        for span, (first, last) in sorted(self._known().items()):
            if out and first - out[-1][1] <= self.gap:
                out[-1] = (out[-1][0], last, [*out[-1][2], span])
            else:
                out.append((first, last, [span]))
        return out

    @staticmethod
    def _drop(state: MapState, gone: list[tuple], stay: list[tuple[tuple, tuple]]) -> None:
        """Takes keys out of a map, or if most go, all of it, and puts back what stays."""
        if len(gone) <= len(stay):
            for k in gone:
                state.removeKey(k)
            return
        state.clear()
        for k, v in stay:
            state.updateValue(k, v)

    def _closed(self, key: tuple, watermark: int) -> Iterator[pd.DataFrame]:
        """Rows of the chains that the watermark (in milliseconds) has passed, whose state goes; a timer for the next of the others to close."""
        chains = self._chains()
        over = [c for c in chains if (c[1] + self.gap) <= watermark * 1000]
        if over:
            chain_of = {span: n for n, c in enumerate(over) for span in c[2]}
            seen: dict[tuple[int, int, int], np.ndarray] = {}
            gone, stay = [], []
            for k, (bits,) in self.tiles.iterator():
                if k[0] in chain_of:
                    tile, own = (chain_of[k[0]], k[1], k[2]), np.frombuffer(bytes(bits), np.uint8)
                    seen[tile] = seen[tile] | own if tile in seen else own
                    gone.append(tuple(k))
                else:
                    stay.append((tuple(k), bytes(bits)))
            self._drop(self.tiles, gone, [(k, (bits,)) for k, bits in stay])
            left = [(span, *times) for span, times in self._known().items() if span not in chain_of]
            self.spans.put(left) if left else self.spans.clear()
            cells = np.zeros(len(over), np.int64)
            for (n, _, _), bits in seen.items():
                cells[n] += int(np.unpackbits(bits).sum())
            yield pd.DataFrame({"case_id": key[0], "start": [c[0] for c in over], "cells": cells})
        closes = [-(-(c[1] + self.gap) // 1000) for c in chains if (c[1] + self.gap) > watermark * 1000]
        wanted = {min(closes)} if closes else set()
        there = set(self.handle.listTimers())
        for t in there - wanted:
            self.handle.deleteTimer(t)
        for t in wanted - there:
            self.handle.registerTimer(t)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        for frame in rows:
            self._add(frame["us"].to_numpy(np.int64), frame["x"].to_numpy(np.float64), frame["y"].to_numpy(np.float64))
        yield from self._closed(key, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._closed(key, timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


def covered_cells(hotspots: DataFrame, radius: float, cell: float, gap: str = "12 hours", late: str = "1 day") -> DataFrame:
    """(case_id, chain_start, cells) of each closed chain of a stream: its covered cells, each counted once.

    No value of the state grows: a chain has a row of bits for each tile and span of time. Its state leaves when the watermark passes its last time by `gap`.
    Rows without time or place take no part, late ones are dropped. Needs the RocksDB state store, which drained() sets for it.
    """
    rows = hotspots.withWatermark("sat_ts", late).where("sat_ts is not null and x is not null and y is not null")
    plain = rows.select("case_id", "sat_ts", F.unix_micros("sat_ts").alias("us"), F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    chains = plain.groupBy("case_id").transformWithStateInPandas(_Cover(radius, cell, pd.Timedelta(gap) // pd.Timedelta("1us")), "case_id long, start long, cells long", "Append", "EventTime")
    return chains.select("case_id", F.timestamp_micros("start").alias("chain_start"), "cells")


def case_status(log: DataFrame) -> DataFrame:
    """(case_id, step, failed) so far (update mode): the latest step, and whether a traceback was logged."""
    step = step_number(F.col("text"))
    return log.groupBy("case_id").agg(F.max_by(step, F.when(step.isNotNull(), F.col("line_no"))).alias("step"), F.bool_or(F.col("text").contains(TRACEBACK)).alias("failed"))


#: A line as the state of a group of cases holds it: what its text says in bits, and the words of the lines that count.
STEPPED, CRASHED, OVER, ERRED, NO_CASE = 1, 2, 4, 8, 16
LINE = ["case_id", "line_no", "marks", "step", "label", "error"]


def _last_lines(lines: pd.DataFrame, tail: int) -> pd.DataFrame:
    """The last `tail` lines of each case and the line of its latest step, sorted by case and line; of other lines' words none are left."""
    none, case = lines["marks"].to_numpy() & NO_CASE, lines["case_id"].to_numpy()
    lines = lines.iloc[np.lexsort((lines["line_no"].to_numpy(), case, none))]
    starts, back = _cases(lines)
    marks = lines["marks"].to_numpy()
    step, error = _latest(marks & STEPPED > 0, starts), _latest((marks & ERRED > 0) & (back <= tail), starts)
    keep = back <= tail
    keep[step[step >= 0]] = True
    for words, at in (("label", step), ("error", error)):
        told = np.full(len(lines), None, object)
        told[at[at >= 0]] = lines[words].to_numpy(object)[at[at >= 0]]
        lines = lines.assign(**{words: told})
    return lines[keep]


def _cases(lines: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted lines, where each case begins, and each line's place from its case's end, from 1."""
    none, case = lines["marks"].to_numpy() & NO_CASE, lines["case_id"].to_numpy()
    starts = np.r_[0, np.flatnonzero((case[1:] != case[:-1]) | (none[1:] != none[:-1])) + 1]
    ends = np.r_[starts[1:], len(lines)]
    return starts, np.repeat(ends, ends - starts) - np.arange(len(lines))


def _latest(found: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The last row of each case that is found, or -1."""
    return np.maximum.reduceat(np.where(found, np.arange(len(found)), -1), starts)


def _told(lines: pd.DataFrame, tail: int, end: int) -> pd.DataFrame:
    """(case_id, status, step, label, error) of the cases of sorted lines."""
    starts, back = _cases(lines)
    marks = lines["marks"].to_numpy()
    over = _latest((marks & OVER > 0) & (back <= end), starts) >= 0
    crashed = _latest((marks & CRASHED > 0) & (back <= tail), starts) >= 0
    step, error = _latest(marks & STEPPED > 0, starts), _latest((marks & ERRED > 0) & (back <= tail), starts)
    status = np.select([over, step < 0, crashed], ["done", "starting", "failed"], "running").astype(object)
    word = lambda c, at, there: np.where(there, lines[c].to_numpy(object)[at], None)
    numbers = np.where(over, LAST_STEP, word("step", step, step >= 0))
    cases = word("case_id", starts, marks[starts] & NO_CASE == 0)
    whole = lambda x: pd.Series(x, dtype="Int64")
    return pd.DataFrame({"case_id": whole(cases), "status": status, "step": whole(numbers), "label": word("label", step, step >= 0), "error": word("error", error, (status == "failed") & (error >= 0))})


def _tails(tail: int, end: int) -> Callable[[tuple, Iterator[pd.DataFrame], GroupState], Iterator[pd.DataFrame]]:
    """Takes the lines of a batch into the state of a group of cases and tells the states of those that had lines."""
    most = max(tail, end)

    def update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held, met = pa.ipc.open_stream(state.get[0]).read_pandas() if state.exists else None, []
        for frame in frames:
            met.append(frame[["case_id", "marks"]].assign(marks=frame["marks"] & NO_CASE).drop_duplicates())
            held = _last_lines(frame[LINE] if held is None else pd.concat([held, frame[LINE]], ignore_index=True), most)
        sink = pa.BufferOutputStream()
        table = pa.Table.from_pandas(held, LINE_SCHEMA, preserve_index=False)
        with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(table)
        state.update((sink.getvalue().to_pybytes(),))
        touched = pd.MultiIndex.from_frame(pd.concat(met).drop_duplicates())
        yield _told(held[pd.MultiIndex.from_arrays([held["case_id"], held["marks"] & NO_CASE]).isin(touched)], tail, end)

    return update


LINE_SCHEMA = pa.schema([("case_id", pa.int64()), ("line_no", pa.int64()), ("marks", pa.int32()), ("step", pa.int64()), ("label", pa.string()), ("error", pa.string())])


def case_tail(log: DataFrame, tail: int = 60, end: int = 10, groups: int = 2048) -> DataFrame:
    """(case_id, status, step, label, error) as case_state() gives them, from a stream of lines (case_id, line_no, text) in any batches (update mode).

    Texts are read before they meet the state. Cases share `groups` rows of state, so that its calls do not grow with the cases; of a case there are the last `tail` lines,
    as numbers and bits, and the line of its latest step. A batch frame is case_state()'s.
    """
    if not log.isStreaming:
        return case_state(log, tail=tail, end=end)
    text, line = F.col("text"), F.col("line_no")
    step = F.when(line.isNotNull(), step_number(text))
    bits = {STEPPED: step.isNotNull(), CRASHED: text.contains(TRACEBACK), OVER: text.contains(COMPLETED), ERRED: text.rlike(ERROR_LINE), NO_CASE: F.col("case_id").isNull()}
    marks = reduce(lambda a, b: a + b, [F.when(found, bit).otherwise(0) for bit, found in bits.items()])
    words = {"label": F.when(bits[STEPPED], F.regexp_extract(text, STEP, 2)), "error": F.when(bits[ERRED], F.substring(F.trim(text), 1, 52))}
    whole = {"case_id": F.coalesce("case_id", F.lit(0)).cast("long"), "line_no": F.coalesce(line, F.lit(-(2**63))).cast("long"), "marks": marks, "step": F.coalesce(step, F.lit(0).cast("long"))}
    rows = log.select(F.pmod(F.xxhash64("case_id"), F.lit(groups)).alias("bucket"), *[c.alias(k) for k, c in (whole | words).items()])
    out = "case_id long, status string, step long, label string, error string"
    return rows.groupBy("bucket").applyInPandasWithState(_tails(tail, end), out, "lines binary", "update", GroupStateTimeout.NoTimeout)


def hourly_wind(weather: DataFrame, late: str = "1 hour") -> DataFrame:
    """(case_id, hour, wind_kph, n): means of closed hours."""
    rows = weather.withWatermark("ts", late).groupBy("case_id", F.window("ts", "1 hour").alias("w"))
    return rows.agg(F.avg("wind_kph").alias("wind_kph"), F.count("*").alias("n")).select("case_id", F.col("w.start").alias("hour"), "wind_kph", "n")


def closed_hours(hotspots: DataFrame, late: str = "6 hours") -> DataFrame:
    """(case_id, hour, n): hotspots (case_id, det_id, sat_ts) of closed hours, each det_id once; rows whose hour was closed when they came are dropped, and counted by the engine one by one."""
    each = hotspots.withWatermark("sat_ts", late).select("case_id", "det_id", F.window("sat_ts", "1 hour").alias("w")).dropDuplicates(["case_id", "det_id", "w"])
    return each.groupBy("case_id", "w").agg(F.count("*").alias("n")).select("case_id", F.col("w.start").alias("hour"), "n")


class _Dropped(StreamingQueryListener):
    """Rows that a query's stateful operators dropped as too late, by batch."""

    def __init__(self) -> None:
        self.late: dict[str, dict[int, int]] = {}
        self.over: dict[str, threading.Event] = {}

    def ended(self, run: str) -> threading.Event:
        return self.over.setdefault(run, threading.Event())

    def onQueryStarted(self, event: object) -> None:
        pass

    def onQueryProgress(self, event: object) -> None:
        p = event.progress
        self.late.setdefault(str(p.runId), {})[p.batchId] = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)

    def onQueryIdle(self, event: object) -> None:
        pass

    def onQueryTerminated(self, event: object) -> None:
        self.ended(str(event.runId)).set()


def drained_with_late(stream: DataFrame, folder: str, name: str | None = None) -> tuple[DataFrame, DataFrame]:
    """drained() in append mode, and (batch, late): how many rows each batch with late ones dropped, a row for each such batch, kept beside the stream's rows."""
    spark, listener, name = stream.sparkSession, _Dropped(), name or f"stream-{uuid.uuid4().hex}"
    spark.streams.addListener(listener)
    try:
        out = drained(stream, folder, name=name, listener=listener)
    finally:
        spark.streams.removeListener(listener)
    counts = [(batch, late) for run in listener.late.values() for batch, late in run.items() if late]
    spark.createDataFrame(counts, "batch long, late long").write.mode("append").parquet(f"{folder}/{name}/late")
    return out, spark.read.parquet(f"{folder}/{name}/late")


#: The state store that operators with state of several kinds need.
STORE, ROCKS = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def drained(stream: DataFrame, folder: str, mode: str = "append", name: str | None = None, listener: _Dropped | None = None) -> DataFrame:
    """Runs a stream over what is there now and returns all that it wrote; with mode update or complete, the rows of the last batch of each key's first column.

    State and rows lie in `folder` under `name` (None: a new one). Called again with that name, it goes on where it stopped: each batch overwrites a table of its own, so
    one that is run again after a failure counts once.
    """
    path = f"{folder}/{name or f'stream-{uuid.uuid4().hex}'}"

    def write(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/out/__batch={n}")

    conf = stream.sparkSession.conf
    before = conf.get(STORE, None)
    conf.set(STORE, ROCKS)
    try:
        query = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{path}/state").foreachBatch(write).trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        conf.unset(STORE) if before is None else conf.set(STORE, before)
    if listener is not None:
        listener.ended(str(query.runId)).wait(60)  # its events come after the query's end
    if query.exception() is not None:
        raise query.exception()
    out = stream.sparkSession.read.schema(T.StructType([*stream.schema.fields, T.StructField("__batch", T.IntegerType())])).parquet(f"{path}/out")
    if mode == "append":
        return out.drop("__batch")
    key = stream.columns[0]
    last = out.groupBy(key).agg(F.max("__batch").alias("__batch"))
    return out.join(last, [key, "__batch"]).drop("__batch")
