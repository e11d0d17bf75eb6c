from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from cinderframe.llm.packing import LENGTHS as PERMITTED
from cinderframe.llm.packing import best_fit, classes, cost, op6_packing, pack, packed, planned

LENGTHS = (16, 32, 64)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60))
def test_bins_hold_their_items(sizes):
    sizes = sorted(sizes, reverse=True)
    bins, starts, lengths = pack(sizes, LENGTHS)
    held = defaultdict(list)
    for s, b, a in zip(sizes, bins, starts):
        held[b].append((a, a + s))
    assert sorted(held) == list(range(len(lengths)))
    for b, spans in held.items():
        spans.sort()
        assert all(x[1] == y[0] for x, y in zip(spans, spans[1:])) and spans[0][0] == 0
        assert lengths[b] == min(c for c in LENGTHS if c >= spans[-1][1])


def brute(sizes, lengths, opened):
    """Tightest open bin, else one of the planned length, the last bin of equal room first, with plain lists."""
    ends, open_ = classes(lengths), []
    for s in sizes:
        fits = [(room, -at, i) for i, (room, used, at) in enumerate(open_) if room >= s]
        if fits:
            i = min(fits)[2]
        else:
            open_.append([next(c for e, c in zip(ends, opened) if e >= s), 0, 0])
            i = len(open_) - 1
        open_[i][0] -= s
        open_[i][1] += s
        open_[i][2] = max(o[2] for o in open_) + 1
    return [next(c for c in lengths if c >= used) for _, used, _ in open_]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=40), st.integers(0, 3**9))
def test_same_bins_as_plain_best_fit(sizes, pick):
    sizes = sorted(sizes, reverse=True)
    opened = []
    for end in classes(LENGTHS):
        fit = [c for c in LENGTHS if c >= end]
        opened.append(fit[pick % len(fit)])
        pick //= 3
    assert best_fit(sizes, LENGTHS, opened)[2] == brute(sizes, LENGTHS, opened)


def spent(bins):
    return sum(map(cost, bins[2]))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), min_size=1, max_size=60))
def test_costs_no_more_than_any_fixed_length(sizes):
    sizes = sorted(sizes, reverse=True)
    fixed = [spent(best_fit(sizes, LENGTHS, [max(c, next(x for x in LENGTHS if x >= e)) for e in classes(LENGTHS)])) for c in LENGTHS]
    assert spent(pack(sizes, LENGTHS)) <= spent(planned(sizes, LENGTHS)) <= min(fixed)


def test_joint_plan_beats_every_uniform_one():
    # Three of 5,400 fill the longest length, and there is nothing small to fill shorter bins with; 2,000 fill a length of their own.
    sizes = [5400] * 30 + [2000] * 40
    fixed = [spent(best_fit(sizes, PERMITTED, [max(c, next(x for x in PERMITTED if x >= e)) for e in classes(PERMITTED)])) for c in PERMITTED]
    assert spent(pack(sizes, PERMITTED)) < min(fixed)


@pytest.mark.parametrize("group_tokens", [1_000_000, 500])
def test_every_token_is_packed_once(documents, group_tokens):
    texts = ["é" * (i * 5 % 37) for i in range(200)] + [None, "", "long " * 2000] + ["same"] * 100
    rows = packed(documents(texts), LENGTHS, group_tokens=group_tokens).collect()
    parts = defaultdict(list)
    for r in rows:
        parts[r.doc_id].append((r["from"], r["from"] + r.tokens))
    for i, t in enumerate(texts):
        spans = sorted(parts[i])
        assert spans[0][0] == 0 and spans[-1][1] == len((t or "").encode()) + 1 and all(x[1] == y[0] for x, y in zip(spans, spans[1:]))
    bins = defaultdict(list)
    for r in rows:
        bins[r.group, r.bin].append(r)
    for rs in bins.values():
        rs.sort(key=lambda r: r.start)
        assert all(x.start + x.tokens == y.start for x, y in zip(rs, rs[1:]))
        assert {(r.bin_tokens, r.bin_length) for r in rs} == {(sum(r.tokens for r in rs), min(c for c in LENGTHS if c >= rs[0].bin_tokens))}
    if group_tokens > 10**5:
        assert sum(r.tokens for r in rows) / sum(rs[0].bin_length for rs in bins.values()) > 0.95


def test_empty(documents):
    assert packed(documents(["a"]).limit(0)).count() == 0


def test_rows_without_tokens_stay(spark):
    df = spark.createDataFrame([(1, 5), (2, 0), (3, None), (None, 70), (2, 0)], "doc_id long, n int")
    rows = packed(df, LENGTHS, tokens=F.col("n")).collect()
    assert sorted((r.doc_id or 0, r["from"], r.tokens) for r in rows) == [(0, 0, 64), (0, 64, 6), (1, 0, 5), (2, 0, 0), (2, 0, 0), (3, 0, 0)]


def test_query_on_a_table(documents, tmp_path):
    texts = ["é" * (i * 5 % 1037) for i in range(200)] + [None, "", "long " * 200_000] + ["same"] * 100
    documents(texts).write.parquet(f"{tmp_path}/documents.parquet")
    total = defaultdict(int)
    for r in op6_packing(documents(texts).sparkSession, str(tmp_path)).collect():
        total[r.doc_id] += r.tokens
        assert r.start + r.tokens <= r.bin_tokens <= r.bin_length and r.bin_length in PERMITTED
    assert total == {i: len((t or "").encode()) + 1 for i, t in enumerate(texts)}


def test_the_split_of_the_table_does_not_matter(documents):
    rows = documents(["x" * (k % 900) for k in range(600)] + [None, "", ""])
    rows = rows.unionByName(rows.where("doc_id % 50 = 0"))
    once, twice, more = (sorted(map(repr, packed(rows.repartition(n), group_tokens=40_000).collect())) for n in (1, 5, 50))
    assert once == twice == more
