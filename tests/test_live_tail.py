"""State of cases by the last lines of their logs, in whatever batches the lines come."""

import random

from cinderframe.operators import runlog
from cinderframe.streaming import live

SCHEMA = "case_id long, line_no long, text string"
TEXTS = ["=== STEP 3: burn ===", "=== STEP 12: end ===", runlog.TRACEBACK, "ValueError: no value", "  KeyError 'x' " + "y" * 80, f"-- {runlog.COMPLETED}", "line", None, ""]


def lines(seed):
    """Cases of few and of many lines, with what counts at both sides of the last 10 and 60 lines; one without a number."""
    rng = random.Random(seed)
    out = []
    for case in [*range(60), None]:
        n = 90 if case is None else rng.choice([1, 9, 59, 60, 61, 300])
        common = rng.choice([0.002, 0.03, 0.5])
        out += [(case, k, rng.choice(TEXTS[:6]) if rng.random() < common else rng.choice(TEXTS[6:])) for k in range(n)]
    return out


def told(df):
    return sorted(map(str, df.select("case_id", "status", "step", "label", "error").collect()))


def test_tail_in_batches_equals_the_batch_state(spark, tmp_path):
    """Lines in any order, a few groups of state or many; the state after each batch is that of all lines so far."""
    rows = lines(4)
    random.Random(5).shuffle(rows)
    parts = [rows[k::3] for k in range(3)]
    stream = lambda groups: live.case_tail(spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in/*")), groups=groups)
    for k, part in enumerate(parts):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.parquet(str(tmp_path / f"in/{k}"))
        seen = spark.createDataFrame([r for p in parts[: k + 1] for r in p], SCHEMA)
        want = told(runlog.case_state(seen))
        assert len({r.split("status=")[1].split(",")[0] for r in want}) == 4
        assert told(live.case_tail(seen)) == want
        for groups in (2, 2048):
            out = live.drained(stream(groups), str(tmp_path), "update", name=f"tail{groups}")
            assert [r for r in told(out) if "case_id=None" not in r] == [r for r in want if "case_id=None" not in r]
            batch = spark.read.parquet(str(tmp_path / f"tail{groups}/out/__batch={k}"))
            assert set(told(batch)) <= set(want) and batch.where("case_id is null").count() == 1


def test_calls_of_the_state_do_not_grow_with_the_cases(spark, tmp_path):
    """Cases share rows of state, and a row holds the last lines alone."""
    for k in range(2):
        spark.range(400).selectExpr("id % 200 as case_id", f"id div 200 + {k * 70} as line_no", "'=== STEP 1: a ===' as text").coalesce(1).write.parquet(str(tmp_path / f"in/{k}"))
        stream = live.case_tail(spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in/*")), tail=3, end=1, groups=8)
        assert live.drained(stream, str(tmp_path), "update", name="tail").count() == 200
    state = spark.read.format("statestore").option("path", str(tmp_path / "tail/state")).load()
    assert state.count() <= 8
