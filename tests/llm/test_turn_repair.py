import hashlib
import heapq
import random
import re
import zlib

import pytest

from cinderframe.llm.ordering import positions
from cinderframe.llm.turn_repair import INITIALS, chained, letter, op13_turn_repair

NEXT = {"": "su", "s": "u", "u": "a", "a": "u"}


def brute_edits(turns):
    """(cost, audit) by search over (turns read, last initial): the cheapest script, then the ASCII-least."""
    heap, seen = [(0, "", 0, "")], set()
    while heap:
        cost, audit, i, at = heapq.heappop(heap)
        if i == len(turns) and at in ("", "a"):
            return cost, audit
        if (i, at) in seen:
            continue
        seen.add((i, at))
        for role in NEXT[at]:
            if role != "s":
                heapq.heappush(heap, (cost + 3, audit + "I", i, role))
        if i < len(turns):
            initial, fault = turns[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, at))
            if fault not in (1, 2):
                more = 3 * (fault == 3)
                for role in NEXT[at]:
                    if role == initial:
                        heapq.heappush(heap, (cost + more, audit + "K", i + 1, role))
                    elif role != "s":
                        heapq.heappush(heap, (cost + 3 + more, audit + "R", i + 1, role))


def brute(rows):
    """The query's rows for (conv_id, turn, role, text)."""
    out, by = [], {}
    for c, t, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        what = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = "" if what == 1 else re.sub("[.!?]", "", text) if what == 2 else text
        by.setdefault(c, []).extend([(t is not None, t or 0, "user" if what == 4 else role, text)] * {0: 0, 3: 2}.get(what, 1))
    for c, turns in by.items():
        turns.sort()
        seen, faults = set(), []
        for _, _, role, text in turns:
            kept = re.sub(r"[\x20\x09-\x0D]", "", text)
            faults.append(1 if not kept else 2 if (role, text) in seen else 3 if kept[-1] not in ".!?" else 0)
            seen.add((role, text))
        initials = [r[:1] if r[:1] in ("s", "u", "a") and r else "-" for _, _, r, _ in turns]
        cost, audit = brute_edits(list(zip(initials, faults)))
        lines, i, at = [], 0, ""
        for e in audit:
            if e == "D":
                i += 1
                continue
            want = "a" if at == "u" else "u"
            role, text = ({"u": "user", "a": "assistant"}[want], "") if e == "I" else (turns[i][2] if e == "K" else {"u": "user", "a": "assistant"}[want], turns[i][3])
            i += e != "I"
            lines.append(f"{role}:{text}")
            at = role[0]
        times = [t for known, t, _, _ in turns if known]
        gaps = max(times) - min(times) + 1 - len(set(times)) if times else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        out.append((c, gaps, faults.count(1), faults.count(2), faults.count(3), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("chunk", [3, 7, 40])
def test_pieces_are_edited_as_the_whole_is(chunk):
    draw = random.Random(chunk)
    for _ in range(300):
        turns = [(draw.choice("suaua-"), draw.choice([0, 0, 0, 1, 2, 3])) for _ in range(draw.randrange(1, 17))]
        letters = "".join(letter(INITIALS.index(i), f) for i, f in turns)
        cost, steps = chained([letters[k : k + chunk] for k in range(0, len(letters), chunk)])
        assert (cost, "".join(a for _, a in steps)) == brute_edits(turns)


def awkward():
    rows = [(c, t, draw.choice(["user", "assistant", "system", "assistant", "user"]), draw.choice(["Hi.", "Well", "So!", "", " \t", "A long one. ", "Yes?\n", f"n {t}."])) for draw in [random.Random(1)] for c in range(-3, 60) for t in range(draw.randrange(0, 9))]
    rows += [(70, None, "user", "x."), (70, 2, None, None), (70, 2, "tool", "y."), (70, 9, "", "z."), (None, 1, "user", "a."), (None, None, "assistant", "b"), (71, None, None, None)]
    rows += [(80, t, "user" if t % 3 else "assistant", f"turn {t // 2}.") for t in range(150)] + [(81, 0, "user", "long " * 100_000 + ".")] + [(82, 1, "user", "same.")] * 5
    return rows


def test_query_equals_brute_force(spark, tmp_path):
    rows = awkward()
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], "conv_id long, turn long, role string, text string, pos string, what int, piece string")
    df.repartition(7).write.parquet(f"{tmp_path}/conversations.parquet")
    got = [tuple(r) for r in op13_turn_repair(spark, str(tmp_path)).collect()]
    want = brute(rows)
    gone = {r[0] for r in rows} - {w[0] for w in want}
    want += [(c, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c in gone]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    df.limit(0).write.parquet(f"{tmp_path}/none/conversations.parquet")
    assert op13_turn_repair(spark, f"{tmp_path}/none").count() == 0


def test_given_conversations_equal_brute_force(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert {tuple(r) for r in op13_turn_repair(spark, sf).collect()} >= set(brute(rows))


def test_positions_across_ranges(spark):
    df = spark.createDataFrame([(None if k == 3 else k % 3 if k % 5 else 1, k) for k in range(2000)], "k long, v long").repartition(9)
    got = positions(df, "k", "v").collect()
    seen = {}
    for r in sorted(got, key=lambda r: r.v):
        assert r.pos == seen.get(r.k, 0)
        seen[r.k] = r.pos + 1
    assert len(got) == 2000 and positions(df.limit(0), "k", "v").count() == 0
