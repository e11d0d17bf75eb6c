"""Repair of conversations whose turns do not alternate: cheapest edits by Wagner-Fischer alignment to the grammar string of each feasible length.

Good role initials are `(s?(ua)+)?`. Turns are cut into pieces of CHUNK, so that a conversation of any length is spread over tasks. A piece is aligned, from
each state in which it can begin, to every length of grammar string that may still beat the incumbent, within Ukkonen's band of its cost; that leaves
the cheapest and, of equal ones, the ASCII-least audit for each state in which it can end. Pieces are then chained from the last one backwards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .ordering import positions
from .tables import durable, read

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Turns of a piece.
CHUNK = 32
INF = 1 << 60
#: A turn's letter: its initial's place in INITIALS, and its fault's in FAULTS.
INITIALS, FAULTS = "sua-", ("", "blank", "duplicate", "truncated")
#: States: nothing yet, after s, after u, after a; the strings that may follow each of them, without end.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
FOLLOW = {START: ("ua", "sua"), AFTER_S: ("ua",), AFTER_U: ("au",), AFTER_A: ("ua",)}
AFTER = {"s": AFTER_S, "u": AFTER_U, "a": AFTER_A}
ROLE = {"u": "user", "a": "assistant"}

Paths = dict[int, tuple[int, str]]


def letter(initial: int, fault: int) -> str:
    return chr(65 + 4 * initial + fault)


def _grammar(kind: str, length: int) -> str:
    """The first `length` letters of an alternating string that begins as `kind` does."""
    lead, cycle = (kind[0], kind[1:]) if kind[0] == "s" else ("", kind)
    return (lead + cycle * (length // 2 + 1))[:length]


def _align(turns: list[tuple[str, int]], target: str, bound: int, open_end: bool) -> tuple[int, str] | None:
    """Cost and least audit of turning `turns` into `target`, if it costs no more than `bound`.

    rest[i][j] is the cost of what is left after i turns and j letters. Cells more than bound / DELETE below or bound / INSERT above the diagonal cannot be on
    such a path. Unless open_end, nothing is inserted after the last turn: that is the next piece's part.
    """
    n, m = len(turns), len(target)
    below, above = bound // DELETE, bound // INSERT
    rest = [[INF] * (m + 1) for _ in range(n + 1)]
    for i in range(n, -1, -1):
        row, after = rest[i], rest[i + 1] if i < n else None
        for j in range(min(m, i + above), max(0, i - below) - 1, -1):
            best = INF
            if i == n and j == m:
                best = 0
            if j < m and target[j] != "s" and (i < n or open_end):
                best = min(best, INSERT + row[j + 1])
            if after is not None:
                initial, fault = turns[i]
                best = min(best, DELETE + after[j])
                if j < m and fault not in (1, 2):
                    extra = TRUNCATED if fault == 3 else 0
                    best = min(best, (KEEP if initial == target[j] else REROLE if target[j] != "s" else INF) + extra + after[j + 1])
            row[j] = min(best, INF)
    if rest[0][0] > bound:
        return None
    i = j = 0
    audit = []
    while (i, j) != (n, m):
        left = rest[i][j]
        initial = turns[i][0] if i < n else ""
        if i < n and left == DELETE + rest[i + 1][j]:
            audit, i = [*audit, "D"], i + 1
        elif j < m and target[j] != "s" and (i < n or open_end) and left == INSERT + rest[i][j + 1]:
            audit, j = [*audit, "I"], j + 1
        else:
            audit, i, j = [*audit, "K" if initial == target[j] else "R"], i + 1, j + 1
    return rest[0][0], "".join(audit)


@lru_cache(maxsize=100_000)
def transfers(letters: str, entry: int, last: bool) -> Paths:
    """For each state in which a piece can end, begun in `entry`: (cost, audit) of the cheapest edits, of equal ones the ASCII-least."""
    turns = [(INITIALS[(ord(c) - 65) // 4], (ord(c) - 65) % 4) for c in letters]
    free = sum(f not in (1, 2) for _, f in turns)  # what is not blank or duplicate
    must = DELETE * (len(turns) - free)
    worst = DELETE * len(turns) + 3 * INSERT  # all go, and what leads to any state comes in
    least = lambda m: must + (INSERT * (m - free) if m > free else DELETE * (free - m))
    best: Paths = {}
    for kind in FOLLOW[entry]:
        # A length costs at least its insertions or deletions; the likely ones come first and set the bound. Only a turn that is kept gives an s.
        if kind[0] == "s" and not any(i == "s" and f not in (1, 2) for i, f in turns):
            continue
        for m in sorted(range(kind[0] == "s", free + worst // INSERT + 1), key=lambda m: (least(m), m)):
            target = _grammar(kind, m)
            end = AFTER[target[-1]] if m else entry
            if last and end not in (START, AFTER_A):
                continue
            bound = best[end][0] if end in best else worst
            if least(m) > bound:
                continue
            got = _align(turns, target, bound, last)
            if got is not None and (end not in best or got < best[end]):
                best[end] = got
    return best


def chained(pieces: list[str]) -> tuple[int, list[tuple[int, str]]]:
    """(cost, [(state in which it begins, audit) of each piece]) of a conversation's pieces."""
    ahead: Paths = {START: (0, ""), AFTER_A: (0, "")}
    steps: list[dict[int, tuple[int, str, int]]] = []
    for k in range(len(pieces) - 1, -1, -1):
        here: dict[int, tuple[int, str, int]] = {}
        for entry in (START,) if k == 0 else range(4):
            # No audit of a piece begins another one that ends elsewhere, so the pieces' own audits decide between equal costs.
            ways = [(cost + ahead[end][0], audit, end) for end, (cost, audit) in transfers(pieces[k], entry, k == len(pieces) - 1).items() if end in ahead]
            if ways:
                here[entry] = min(ways)
        steps.append(here)
        ahead = {e: (w[0], "") for e, w in here.items()}
    state, out = START, []
    for here in reversed(steps):
        _, audit, end = here[state]
        out.append((state, audit))
        state = end
    return ahead[START][0], out


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after the damage that crc32 of `conv_id:turn` names; nulls are one space, except in conv_id and turn themselves."""
    named = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    what = F.crc32(named) % 20
    rows = conversations.select("conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")], what.alias("what")).where("what != 0")
    text = F.when(F.col("what") == 1, "").when(F.col("what") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("what") == 4, "user").otherwise(F.col("role"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), F.when(F.col("what") == 3, 2).otherwise(1))).alias("copy")).drop("copy")


def _letters(rows: DataFrame) -> DataFrame:
    """(conv_id, piece, letters): the turns of each piece, a letter each."""
    solid, last = F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    said = [F.xxhash64(F.lit(k), "role", "text").alias(f"h{k}") for k in (1, 2)]
    slim = rows.select("conv_id", "pos", F.substring("role", 1, 1).alias("initial"), solid.alias("solid"), last.alias("last"), *said)
    same = ["conv_id", "h1", "h2"]
    first = slim.groupBy(*same).agg(F.min("pos").alias("first"))
    met = slim.alias("s").join(first.alias("f"), F.col("s.conv_id").eqNullSafe(F.col("f.conv_id")) & (F.col("s.h1") == F.col("f.h1")) & (F.col("s.h2") == F.col("f.h2")))
    at: Column = F.coalesce(F.nullif(F.instr(F.lit(INITIALS[:3]), F.col("initial")), F.lit(0)), F.lit(4))
    initial = F.when(F.col("initial") == "", 3).otherwise(at - 1)
    fault = F.when(~F.col("solid"), 1).when(F.col("pos") > F.col("first"), 2).when(~F.col("last"), 3).otherwise(0)
    coded = met.select("s.conv_id", "pos", F.char(65 + 4 * initial + fault).alias("c"))
    turns = coded.groupBy("conv_id", F.floor(F.col("pos") / CHUNK).alias("piece")).agg(F.sort_array(F.collect_list(F.struct("pos", "c"))).alias("turns"))
    return turns.select("conv_id", "piece", F.array_join(F.col("turns.c"), "").alias("letters"))


def _whole(frames: Iterator[pd.DataFrame], key: str = "conv_id") -> Iterator[tuple[object, pd.DataFrame]]:
    """(key, rows) of each run of one key, over batches of sorted rows."""
    held: list[pd.DataFrame] = []
    for frame in frames:
        if not len(frame):
            continue
        k = frame[key]
        new = (k != k.shift()) & ~(k.isna() & k.shift().isna())
        for _, run in frame.groupby(new.cumsum(), sort=False):
            v = run[key].iloc[0]
            if held and not (v == held[0][key].iloc[0] or pd.isna(v) and pd.isna(held[0][key].iloc[0])):
                yield held[0][key].iloc[0], pd.concat(held)
                held = []
            held.append(run)
    if held:
        yield held[0][key].iloc[0], pd.concat(held)


def _plans(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each conversation's pieces: how each is edited; the first one's row also has the conversation's counts."""
    for conv_id, rows in _whole(frames):
        pieces = list(rows["letters"])
        cost, steps = chained(pieces)
        every = "".join(pieces)
        faults = [(ord(c) - 65) % 4 for c in every]
        initials = "".join(INITIALS[(ord(c) - 65) // 4] for c in every)
        illegal = sum(initials[i : i + 2] not in ("su", "ua", "au") for i in range(len(initials) - 1))
        counts = {"blank": faults.count(1), "duplicate": faults.count(2), "truncated": faults.count(3), "illegal": illegal, "cost": cost}
        yield pd.DataFrame({"conv_id": pd.array([None if pd.isna(conv_id) else int(conv_id)] * len(pieces), "Int64"), "piece": list(rows["piece"]), "pieces": len(pieces), "entry": [s for s, _ in steps], "audit": [a for _, a in steps], **counts})


def _edited(turns: list, entry: int, audit: str) -> list[str]:
    """Lines `role:text` of a piece after its edits."""
    out, i = [], 0
    state = entry
    for edit in audit:
        if edit == "D":
            i += 1
            continue
        want = "a" if state == AFTER_U else "u"
        if edit == "I":
            out.append(f"{ROLE[want]}:")
        else:
            turn = turns[i]
            i += 1
            role = turn["role"] if edit == "K" else ROLE[want]
            want = role[0]
            out.append(f"{role}:{turn['text']}")
        state = AFTER[want]
    return out


def _texts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each piece's repaired lines, or their digest where the piece is the whole conversation."""
    for frame in frames:
        lines = [_edited(t, e, a) for t, e, a in zip(frame["turns"], frame["entry"], frame["audit"], strict=True)]
        joined = ["\n".join(x) if x else None for x in lines]
        whole = frame["pieces"] == 1
        sha = [hashlib.sha256((x or "").encode()).hexdigest() if w else None for x, w in zip(joined, whole, strict=True)]
        out = frame[["conv_id", "piece"]].copy()
        out["conv_id"] = out["conv_id"].astype("Int64")
        yield out.assign(lines=[None if w else x for x, w in zip(joined, whole, strict=True)], sha=sha)


def _digests(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The digest of each conversation of several pieces, as they come in order; none is held."""
    conv_id, digest, begun = None, None, False
    row = lambda: pd.DataFrame({"conv_id": pd.array([None if pd.isna(conv_id) else int(conv_id)], "Int64"), "sha": [digest.hexdigest()]})
    for frame in frames:
        for k, lines in zip(frame["conv_id"], frame["lines"], strict=True):
            if digest is None or not (k == conv_id or pd.isna(k) and pd.isna(conv_id)):
                if digest is not None:
                    yield row()
                conv_id, digest, begun = k, hashlib.sha256(), False
            if lines is not None:
                digest.update(("\n" if begun else "").encode() + lines.encode())
                begun = True
    if digest is not None:
        yield row()


def repaired(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pieces, conversations) of turns (conv_id, turn, role, text) without nulls but in conv_id and turn.

    pieces: conv_id, piece, entry, audit, lines of those conversations that have several, else the digest. conversations: conv_id, blank, duplicate, truncated,
    illegal, cost, audit, sha. Turns are ordered by turn, nulls first; turns that tie go by role and text. A null conv_id is a conversation like others. Turns in which nothing is
    left to read, and ones that repeat an earlier role and text, are deleted; role initials other than s, u and a are reroled or deleted.
    """
    placed = positions(rows, "conv_id", "turn", "role", "text")
    letters = _letters(placed)
    schema = "conv_id long, piece long, pieces long, entry int, audit string, blank long, duplicate long, truncated long, illegal long, cost long"
    plans = durable(letters.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "conv_id").sortWithinPartitions("conv_id", "piece").mapInPandas(_plans, schema))
    turns = placed.groupBy("conv_id", F.floor(F.col("pos") / CHUNK).alias("piece")).agg(F.sort_array(F.collect_list(F.struct("pos", "role", "text"))).alias("turns"))
    same = F.col("t.conv_id").eqNullSafe(F.col("p.conv_id")) & (F.col("t.piece") == F.col("p.piece"))
    met = turns.alias("t").join(plans.alias("p"), same).select("t.conv_id", "t.piece", "turns", "pieces", "entry", "audit")
    pieces = durable(met.mapInPandas(_texts, "conv_id long, piece long, lines string, sha string"))
    long = pieces.where("sha is null").repartition("conv_id").sortWithinPartitions("conv_id", "piece").mapInPandas(_digests, "conv_id long, sha string")
    shas = pieces.where("sha is not null").select("conv_id", "sha").unionByName(long)
    counts = [F.first(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
    by = plans.groupBy("conv_id").agg(*counts, F.array_join(F.sort_array(F.collect_list(F.struct("piece", "audit")))["audit"], "").alias("audit"))
    return pieces, by.alias("c").join(shas.alias("s"), F.col("c.conv_id").eqNullSafe(F.col("s.conv_id"))).select("c.*", "sha")


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damages `conversations` by rule and repairs them: a row for each conv_id, null included; those without a turn left have zeros. An empty table gives no rows; other columns are not read."""
    conversations = read(spark, sf_dir, "conversations")
    rows = damaged(conversations)
    _, done = repaired(rows)
    turns = rows.groupBy("conv_id").agg((F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"))
    every = conversations.select("conv_id").distinct()
    same = lambda a, b: F.col(f"{a}.conv_id").eqNullSafe(F.col(f"{b}.conv_id"))
    out = every.alias("e").join(done.alias("d"), same("e", "d"), "left").join(turns.alias("t"), same("e", "t"), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("e.conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
