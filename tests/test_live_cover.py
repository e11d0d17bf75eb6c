"""Cover of live chains, in whatever batches the rows come."""

import datetime as dt
import math
import random

from cinderframe.streaming import live

DAY = dt.datetime(2024, 7, 1)
SCHEMA = "case_id long, sat_ts timestamp, x double, y double"


def brute(rows, radius, cell, gap, until):
    out = {}
    for case in {r[0] for r in rows if r[1] is not None and r[2] is not None}:
        chains = []
        for _, t, x, y in sorted(r for r in rows if r[0] == case and r[1] is not None and r[2] is not None):
            if chains and t - chains[-1][1] <= gap:
                chains[-1][1] = t
            else:
                chains.append([t, t, set()])
            for u in range(math.floor((x - radius) / cell), math.floor((x + radius) / cell) + 1):
                for v in range(math.floor((y - radius) / cell), math.floor((y + radius) / cell) + 1):
                    if ((u + 0.5) * cell - x) ** 2 + ((v + 0.5) * cell - y) ** 2 <= radius * radius:
                        chains[-1][2].add((u, v))
        for first, last, cells in chains:
            if last + gap <= until:
                out[case, first] = len(cells)
    return out


def test_cover_in_batches(spark, tmp_path):
    """Places on both sides of zero and of tiles, chains over several batches, the gap itself, rows in any order within a batch, rows without time or place."""
    rng = random.Random(8)
    rows = [(c, DAY + dt.timedelta(minutes=rng.choice([0, 1, 7]) + 30 * rng.randrange(600)), rng.uniform(-900, 900), rng.uniform(-900, 900)) for c in range(4) for _ in range(60)]
    rows += [(9, DAY, 0.0, 0.0), (9, DAY + dt.timedelta(hours=12), 0.0, 0.0), (9, DAY + dt.timedelta(hours=24, seconds=1), 0.0, 0.0), (9, None, 1.0, 1.0), (9, DAY, None, 1.0), (0, DAY + dt.timedelta(days=40), 0.0, 0.0)]
    timed = sorted((r for r in rows if r[1] is not None), key=lambda r: r[1])
    n = len(timed) // 4 + 1
    parts = [timed[i : i + n] for i in range(0, len(timed), n)]
    parts[0] += [r for r in rows if r[1] is None]
    for k, part in enumerate(parts):
        rng.shuffle(part)
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.parquet(str(tmp_path / f"in/{k}"))
    want = brute(rows, 200.0, 50.0, dt.timedelta(hours=12), DAY + dt.timedelta(days=39))
    assert len(want) > 10
    for files in (1, 100):
        # One file a batch goes by age, so by time; rows that come in order are never late.
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files).parquet(str(tmp_path / "in/*"))
        got = live.drained(live.covered_cells(stream, 200.0, 50.0), str(tmp_path / f"out{files}")).collect()
        assert len(got) == len(want) and {(r.case_id, r.chain_start): r.cells for r in got} == want


def test_state_is_rows_of_bounded_size(spark, tmp_path):
    """A long chain over a wide place leaves a row for each tile and span, of the same size each, and none when it has closed."""
    rows = [(1, DAY + dt.timedelta(hours=6 * k), 10_000.0 * k, 0.0) for k in range(40)]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "in/0"))
    stream = lambda: spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in/*"))
    live.drained(live.covered_cells(stream(), 200.0, 50.0), str(tmp_path), name="open")
    state = spark.read.format("statestore").option("path", str(tmp_path / "open/state")).option("stateVarName", "tiles").load()
    sizes = state.selectExpr("length(user_map_value.bits) as n").collect()
    assert len(sizes) >= 40 and {r.n for r in sizes} == {live.TILE * live.TILE // 8}
    spark.createDataFrame([(2, DAY + dt.timedelta(days=99), 0.0, 0.0)], SCHEMA).coalesce(1).write.parquet(str(tmp_path / "in/1"))
    out = live.drained(live.covered_cells(stream(), 200.0, 50.0), str(tmp_path), name="open")
    assert [r.case_id for r in out.collect()] == [1]
    left = spark.read.format("statestore").option("path", str(tmp_path / "open/state")).option("stateVarName", "tiles").load()
    assert {r.case_id for r in left.selectExpr("key.case_id").collect()} == {2}


def test_a_case_has_one_timer_and_chains_close_one_after_the_other(spark, tmp_path):
    """A case of many open chains waits for the next one to close, and each closes in the batch in which the watermark has passed it."""
    rows = [(1, DAY + dt.timedelta(days=2 * k), 0.0, 0.0) for k in range(20)]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "in/0"))
    stream = lambda late: live.covered_cells(spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in/*")), 200.0, 50.0, late=late)
    out = live.drained(stream("15 days"), str(tmp_path), name="open")
    closed = {r.chain_start for r in out.collect()}
    assert closed == {r[1] for r in rows if r[1] + dt.timedelta(hours=12) <= rows[-1][1] - dt.timedelta(days=15)}
    timers = spark.read.format("statestore").option("path", str(tmp_path / "open/state")).option("readRegisteredTimers", True).load()
    assert timers.count() == 1
    for k in range(1, 4):
        spark.createDataFrame([(2, rows[-1][1] + dt.timedelta(days=5 * k), 0.0, 0.0)], SCHEMA).coalesce(1).write.parquet(str(tmp_path / f"in/{k}"))
        out = live.drained(stream("15 days"), str(tmp_path), name="open")
    assert {r.chain_start for r in out.where("case_id = 1").collect()} == {r[1] for r in rows[:-1]}
