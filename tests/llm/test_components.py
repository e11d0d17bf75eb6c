import random

from cinderframe.llm import components as C


def roots(pairs):
    root = {x: x for p in pairs for x in p}
    for a, b in pairs:
        low, high = sorted((root[a], root[b]))
        root = {k: low if v == high else v for k, v in root.items()}
    return root


def test_small_tables_take_few_tasks(spark, monkeypatch):
    """However many partitions shuffles have, a round over few links is a few tasks; with more tasks the roots are the same ones."""
    rng = random.Random(1)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(150)] + [(1000 + k, 1001 + k) for k in range(40)] + [(2000, 2001 + k) for k in range(80)]
    want = {k: v for k, v in roots([p for p in pairs if p[0] != p[1]]).items()}
    links = spark.createDataFrame([*pairs, (None, 1), (5, None)], "a long, b long")
    sc = spark.sparkContext
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 40)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sc.setJobGroup("few", "")
        got = {r.node: r.root for r in C.components(links).collect()}
        tasks = [sc.statusTracker().getStageInfo(s).numTasks for j in sc.statusTracker().getJobIdsForGroup("few") for s in sc.statusTracker().getJobInfo(j).stageIds]
        monkeypatch.setattr(C, "LINKS_OF_TASK", 20)
        more = {r.node: r.root for r in C.components(links).collect()}
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert {k: want[k] for k in got} == got == more and {k for k in want if k not in got} <= set(want.values())
    assert len(tasks) > 20 and sum(n >= 40 for n in tasks) <= 4  # the first table of links alone is dealt to all
