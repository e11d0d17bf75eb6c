"""A prefix trie over conversations, rolled up by centroid decomposition of its parent edges.

A node is named by its smallest member and its depth. A part of the forest is split at its centroid, the deepest node that holds half of the part's weight: the
centroid's children head parts of their own, and the rest stays with the part's top. What the centroid's subtree holds within the part is
summed once and added to the nodes on the path from the centroid to the top. Weights are memberships, so a deep chain and a thousand copies halve alike, and the
rounds grow with the logarithm of the table. Parts of PART_NODES or fewer are finished in memory by the same steps.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ordering import positions
from .tables import durable, read
from .turn_repair import _whole

#: Nodes of a part that one task finishes.
PART_NODES = 20_000
#: Member ids that are joined in one piece before a node's digest.
ID_SPAN = 1024


def rebuilt(conversations: DataFrame, family: int = 5, turns: int = 9) -> tuple[DataFrame, DataFrame]:
    """(rows, lengths) of each conversation c begun anew: the first h turns of c - c % family, h = crc32(c) % turns, then c's own after its first h.

    rows: conv_id, depth from 1, h1 and h2 (64-bit hashes of role and text), bytes of the text; lengths: conv_id, n (0 if no turn is left). Turns go by
    turn, nulls first, ties by role and then hash; null roles and texts are empty. Rows with a null conv_id name no conversation and go.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    named = conversations.where("conv_id is not null").select("conv_id", "turn", role.alias("role"), *[F.xxhash64(F.lit(k), role, text).alias(f"h{k}") for k in (1, 2)], F.octet_length(text).cast("long").alias("bytes"))
    own = positions(named, "conv_id", "turn", "role", "h1", "h2")
    counts = durable(own.groupBy("conv_id").agg(F.count("*").alias("own")).withColumns({"h": F.crc32(F.col("conv_id").cast("string")) % turns, "base": F.col("conv_id") - F.col("conv_id") % family}))
    first = counts.join(counts.select(F.col("conv_id").alias("base"), F.col("own").alias("there")), "base", "left").withColumn("lead", F.least("h", F.coalesce("there", F.lit(0))))
    first = durable(first.select("conv_id", "base", "h", "lead", (F.col("lead") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n")))
    # A base lends its first turns, fewer than `turns`, to the conversations of its family only.
    lent = own.where(F.col("pos") < turns - 1).withColumnRenamed("conv_id", "base").join(first.where("lead > 0").select("conv_id", "base", "lead"), "base").where("pos < lead")
    kept = own.join(first.select("conv_id", "h", "lead"), "conv_id").where("pos >= h").withColumn("pos", F.col("pos") - F.col("h") + F.col("lead"))
    columns = ["conv_id", (F.col("pos") + 1).alias("depth"), "h1", "h2", "bytes"]
    return lent.select(columns).unionByName(kept.select(columns)), first.select("conv_id", "n")


def _paths(rows: DataFrame, lengths: DataFrame) -> DataFrame:
    """(conv_id, depth, s1, s2, p1, p2, bytes, n): each prefix of each conversation by two sums, modulo 2**64, of hashes of its turns with their places, and its parent's sums."""
    hashed = rows.select("conv_id", "depth", *[F.xxhash64(F.lit(k), "depth", "h1", "h2").alias(f"s{k}") for k in (1, 2)], *[F.xxhash64(F.lit(k), "depth", "h1", "h2").alias(f"x{k}") for k in (1, 2)], "bytes")
    summed = positions(hashed, "conv_id", "depth", sums=("s1", "s2")).join(lengths, "conv_id")
    less = [F.expr(f"cast((cast(s{k} as decimal(20)) - x{k} + case when cast(s{k} as decimal(20)) - x{k} > {2**63 - 1} then -{2**64} when cast(s{k} as decimal(20)) - x{k} < -{2**63} then {2**64} else 0 end) as long)").alias(f"p{k}") for k in (1, 2)]
    zero = [F.lit(0).cast("long").alias(c) for c in ("depth", "s1", "s2", "p1", "p2", "bytes")]
    return lengths.select("conv_id", *zero, "n").unionByName(summed.select("conv_id", "depth", "s1", "s2", *less, "bytes", "n"))


def trie(rows: DataFrame, lengths: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, paths): nodes conv_id, depth, parent (null: root), n_convs, n_children, bytes, weight; paths (conv_id, depth, node, parent): the node of each prefix of each conversation."""
    paths = durable(_paths(rows, lengths))
    key = ["depth", "s1", "s2"]
    grouped = durable(paths.groupBy(*key).agg(F.min("conv_id").alias("node"), F.count("*").alias("n_convs"), F.sum(F.col("n") - F.col("depth") + 1).alias("weight"), F.first("bytes").alias("bytes"), F.first("p1").alias("p1"), F.first("p2").alias("p2")))
    above = grouped.select((F.col("depth") + 1).alias("depth"), F.col("s1").alias("p1"), F.col("s2").alias("p2"), F.col("node").alias("parent"))
    nodes = grouped.join(above, ["depth", "p1", "p2"], "left")
    children = nodes.where("depth > 0").groupBy("parent", "depth").agg(F.count("*").alias("n_children")).select(F.col("parent").alias("node"), (F.col("depth") - 1).alias("depth"), "n_children")
    nodes = durable(nodes.join(children, ["node", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))))
    placed = paths.select("conv_id", *key, "n").join(nodes.select(*key, "node", "parent"), key).select("conv_id", "depth", "node", "parent", "n")
    return nodes.select(F.col("node").alias("conv_id"), "depth", "parent", "n_convs", "n_children", "bytes", "weight"), durable(placed)


def _subtrees(parents: list[int], values: list[list[int]]) -> list[list[int]]:
    """For each node of a part, the sums of `values` over its subtree. Parents come before children; the top's is -1."""
    out = [[0] * len(values) for _ in parents]
    todo = [list(range(len(parents)))]
    while todo:
        part = todo.pop()
        top, size = part[0], dict.fromkeys(part, 1)
        for v in reversed(part[1:]):
            size[parents[v]] += size[v]
        centre = next(v for v in reversed(part) if 2 * size[v] >= len(part))
        within, heads, rest = {centre}, {}, []
        total = [x[centre] for x in values]
        for v in part:
            up = parents[v] if v != top else -1
            if v == centre:
                continue
            if up in within:
                within.add(v)
                head = v if up == centre else heads[up][0]
                heads[v] = (head, heads[head][1] if head != v else [])
                heads[v][1].append(v)
                total = [t + x[v] for t, x in zip(total, values, strict=True)]
            else:
                rest.append(v)
        v = centre
        while True:
            out[v] = [a + t for a, t in zip(out[v], total, strict=True)]
            if v == top:
                break
            v = parents[v]
        todo += [members for v, (head, members) in heads.items() if v == head]
        if rest:
            todo.append(rest)
    return out


def _finished(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sums of each node of whole parts, which come sorted by part and depth."""
    def key(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield f.assign(part=list(zip(f["top"], f["top_depth"], strict=True)))

    held: list[pd.DataFrame] = []
    for _, rows in _whole(key(frames), "part"):
        at = {k: i for i, k in enumerate(zip(rows["conv_id"], rows["depth"], strict=True))}
        parents = [-1 if i == 0 else at[(int(p), d - 1)] for i, (p, d) in enumerate(zip(rows["parent"], rows["depth"], strict=True))]
        sums = _subtrees(parents, [rows["leaf"].tolist(), rows["saved"].tolist()])
        held.append(pd.DataFrame({"conv_id": rows["conv_id"].to_numpy(), "depth": rows["depth"].to_numpy(), "leaf": [s[0] for s in sums], "saved": [s[1] for s in sums]}))
        if sum(map(len, held)) > PART_NODES:
            yield pd.concat(held)
            held = []
    if held:
        yield pd.concat(held)


def rollup(nodes: DataFrame, paths: DataFrame, part_nodes: int = PART_NODES, rounds: int = 200) -> DataFrame:
    """(conv_id, depth, leaf, saved): sums over each node's subtree of the columns leaf and saved of nodes (conv_id, depth, parent, weight, leaf, saved)."""
    columns = ["conv_id", "depth", "parent", "weight", "leaf", "saved"]
    found: list[DataFrame] = []
    root = nodes.where("depth = 0").select("conv_id").first()
    if root is None:
        return nodes.select("conv_id", "depth", "leaf", "saved")
    state = durable(nodes.select(*columns, F.lit(root.conv_id).alias("top"), F.lit(0).cast("long").alias("top_depth")))
    done: list[DataFrame] = []
    part = ["top", "top_depth"]
    path = paths.select(F.col("conv_id").alias("of"), F.col("depth").alias("at"), F.col("node").alias("head"), F.col("parent").alias("head_parent"))
    for _ in range(rounds):
        if state.isEmpty():
            break
        sizes = state.groupBy(*part).agg(F.count("*").alias("nodes"), F.max("weight").alias("total"))
        sized = durable(state.join(sizes, part))
        done.append(sized.where(F.col("nodes") <= part_nodes).select(*columns, *part))
        large = sized.where(F.col("nodes") > part_nodes)
        if large.isEmpty():
            break
        centre = F.min_by(F.struct(F.col("conv_id").alias("c"), F.col("depth").alias("c_depth"), F.col("weight").alias("c_weight")), F.struct("weight", -F.col("depth")))
        centres = durable(large.where(2 * F.col("weight") >= F.col("total")).groupBy(*part).agg(centre.alias("b")).select(*part, "b.*"))
        # A node's own path tells which child of the centroid it is under, if any.
        at = large.select(*columns, *part).join(centres, part)
        under = at.join(path, (F.col("conv_id") == F.col("of")) & (F.col("at") == F.col("c_depth") + 1) & (F.col("depth") > F.col("c_depth")), "left")
        is_centre = (F.col("conv_id") == F.col("c")) & (F.col("depth") == F.col("c_depth"))
        marked = durable(under.withColumn("below", F.coalesce(F.col("head_parent") == F.col("c"), F.lit(False))).withColumn("centre", is_centre).drop("of", "at", "head_parent"))
        held = marked.where("below or centre").groupBy(*part).agg(F.sum("leaf").alias("t_leaf"), F.sum("saved").alias("t_saved"))
        up = centres.join(held, part).join(path, (F.col("of") == F.col("c")) & (F.col("at") <= F.col("c_depth")) & (F.col("at") >= F.col("top_depth")))
        adds = durable(up.select(F.col("head").alias("conv_id"), F.col("at").alias("depth"), F.col("t_leaf").alias("leaf"), F.col("t_saved").alias("saved"), "c_weight"))
        found.append(adds.drop("c_weight"))
        heads = marked.where("below").select(*columns, F.col("head").alias("top"), (F.col("c_depth") + 1).alias("top_depth"))
        lighter = marked.where("not below and not centre").join(adds.select("conv_id", "depth", F.col("c_weight").alias("off")), ["conv_id", "depth"], "left")
        rest = lighter.withColumn("weight", F.col("weight") - F.coalesce("off", F.lit(0))).select(*columns, *part)
        state = durable(heads.unionByName(rest))
    else:
        raise RuntimeError(f"parts are not small in {rounds} rounds")
    for small in done:
        found.append(small.repartition(*part).sortWithinPartitions(*part, "depth").mapInPandas(_finished, "conv_id long, depth long, leaf long, saved long"))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every.groupBy("conv_id", "depth").agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved"))


def _id_digests(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A digest of each node's pieces, as they come in order."""
    node, digest, out = None, None, []
    for frame in frames:
        for c, d, ids in zip(frame["node"], frame["depth"], frame["ids"], strict=True):
            if (c, d) != node:
                if digest is not None:
                    out.append((*node, digest.hexdigest()))
                node, digest = (c, d), hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        yield pd.DataFrame(out, columns=["conv_id", "depth", "sha"])
        out = []
    if digest is not None:
        yield pd.DataFrame([(*node, digest.hexdigest())], columns=["conv_id", "depth", "sha"])


def ends(paths: DataFrame) -> DataFrame:
    """(conv_id, depth, sha): for each node at which conversations end, the digest of their ids, ascending, joined by commas. Ids are joined in spans first, so that a node's task sees a row for each span."""
    last = paths.where("depth = n").select("node", "depth", "conv_id", F.floor(F.col("conv_id") / ID_SPAN).alias("span"))
    spans = last.groupBy("node", "depth", "span").agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda i: i.cast("string")), ",").alias("ids"))
    return spans.repartition("node", "depth").sortWithinPartitions("node", "depth", "span").mapInPandas(_id_digests, "conv_id long, depth long, sha string")


def prefix_trie(rows: DataFrame, lengths: DataFrame, part_nodes: int = PART_NODES) -> DataFrame:
    """A row for each node of the trie over turns (conv_id, depth, role, text) of conversations (conv_id, n): what op11_prefix_trie returns. No conversation, no row."""
    nodes, paths = trie(rows, lengths)
    sums = rollup(nodes.withColumn("leaf", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long")).withColumn("saved", (F.col("n_convs") - 1) * F.col("bytes")), paths, part_nodes)
    out = nodes.join(sums, ["conv_id", "depth"]).join(ends(paths), ["conv_id", "depth"], "left")
    return out.select("conv_id", "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", F.col("leaf").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all rebuilt `conversations`. Null roles and texts are empty, repeated rows are turns like others, null conv_ids name no conversation; an empty table gives no rows, other columns are not read."""
    return prefix_trie(*rebuilt(read(spark, sf_dir, "conversations")))


#: crc32 of a decimal, a bit at a time.
_CRC = """xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(conv_id::varchar, ''), lambda x: ascii(x)::bigint)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda p, q: xor(p >> 1, 3988292384 * (p & 1)))), 4294967295)"""
ORACLE = f"""
with own as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
    row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as pos
  from conversations where conv_id is not null
), convs as (select conv_id, conv_id - conv_id % 5 as base, count(*) as n, {_CRC} % 9 as h from own group by conv_id
), led as (select c.*, least(c.h, coalesce(b.n, 0)) as lead from convs c left join convs b on b.conv_id = c.base
), turns as (
  select l.conv_id, o.pos as depth, o.role, o.text from led l join own o on o.conv_id = l.base and o.pos <= l.lead
  union all select l.conv_id, o.pos - l.h + l.lead, o.role, o.text from led l join own o on o.conv_id = l.conv_id and o.pos > l.h
), paths as (
  select conv_id, depth, strlen(text) as bytes, md5(string_agg(md5(role || chr(31) || text), '' order by depth) over (partition by conv_id order by depth)) as k from turns
  union all select conv_id, 0, 0, '' from convs
), ends as (select conv_id, k, depth = max(depth) over (partition by conv_id) as ended from paths
), tops as (select conv_id, depth, bytes, k, lag(k) over (partition by conv_id order by depth) as up from paths
), nodes as (select k, any_value(up) as up, min(conv_id) as conv_id, any_value(depth) as depth, count(*) as n_convs, any_value(bytes) as bytes from tops group by k
), kids as (select up, count(*) as n from nodes where up is not null group by up
), grown as (select n.*, coalesce(c.n, 0) as n_children from nodes n left join kids c on c.up = n.k
), below as (select p.k, sum(case when g.n_children = 0 then 1 else 0 end) as n_leaves, sum((g.n_convs - 1) * g.bytes) as saved from grown g join paths p on p.conv_id = g.conv_id and p.depth <= g.depth group by p.k
), ids as (select k, sha256(string_agg(conv_id::varchar, ',' order by conv_id)) as sha from ends where ended group by k)
select g.conv_id, g.depth, u.conv_id as parent_conv_id, g.n_convs, g.n_children, cast(b.n_leaves as bigint) as n_leaves, cast(b.saved as bigint) as saved_tokens, coalesce(i.sha, sha256('')) as ends_sha256
from grown g join below b on b.k = g.k left join nodes u on u.k = g.up left join ids i on i.k = g.k
"""
