"""The union of overlapping polygons as directed edges of its boundary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..folders import once
from ..functions.geometry import edges_of, near_points, segment_distance2, strictly_within, with_bounds
from .small_unions import boundaries


#: Up to so many edges of a key are paired without tiles, and up to a quarter as many polygons.
FEW = 64


def _turned(rings: Column) -> Column:
    """The edges of all rings, turned so that the polygon's inside is on their left: a ring within an even number of others runs counterclockwise."""

    def of(ring: Column) -> Column:
        edges = edges_of(F.array(ring))
        first = edges[0]
        inside = F.filter(rings, lambda r: (r != ring) & strictly_within((first.x1 + first.x2) / 2, (first.y1 + first.y2) / 2, edges_of(F.array(r))))
        twice = F.aggregate(edges, F.lit(0.0), lambda s, e: s + (e.x1 * e.y2 - e.x2 * e.y1))
        right = (twice > 0) == (F.size(inside) % 2 == 0)
        back = F.transform(edges, lambda e: F.struct(e.x2.alias("x1"), e.y2.alias("y1"), e.x1.alias("x2"), e.y1.alias("y2")))
        return F.when(right, edges).otherwise(back)

    return F.flatten(F.transform(F.filter(rings, lambda r: F.size(r) >= 3), of))


def _with_tiles(edges: DataFrame, key: str) -> DataFrame:
    """Edges on tiles as wide as a key's edges are long in the mean, by pieces no longer than that: in the mean at most eight rows an edge, however unequal they are. FEW edges or less of a key lie on one tile."""
    length = F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    mean = edges.groupBy(key).agg(F.avg(length).alias("tile"), (F.count("*") <= FEW).alias("few"))
    n = F.when(F.col("few"), 1).otherwise(F.greatest(F.ceil(length / F.col("tile")), F.lit(1)).cast("int"))
    pieces = edges.join(mean, key).withColumn("n", n).withColumn("i", F.explode(F.sequence(F.lit(1), F.col("n"))))
    at = lambda a, b, k: F.col(a) + (F.col(b) - F.col(a)) * k / F.col("n")
    # Grown a little, as an edge that only touches another one counts.
    span = lambda a, b: F.explode(F.when(F.col("few"), F.array(F.lit(0).cast("long"))).otherwise(F.sequence(F.floor(F.least(at(a, b, F.col("i") - 1), at(a, b, F.col("i"))) / F.col("tile") - 1e-6), F.floor(F.greatest(at(a, b, F.col("i") - 1), at(a, b, F.col("i"))) / F.col("tile") + 1e-6))))
    return pieces.withColumn("tx", span("x1", "x2")).withColumn("ty", span("y1", "y2")).drop("tile", "few", "n", "i").distinct()


def _cuts(edges: DataFrame, key: str, digits: int) -> DataFrame:
    """(key, part, edge, x, y): where edges of different polygons of a key cross or touch."""
    tiled = once(_with_tiles(edges, key))
    side = lambda c: tiled.select(key, "tx", "ty", *[F.col(k).alias(c + k) for k in ("part", "edge", "x1", "y1", "x2", "y2")])
    met = side("a").join(side("b"), [key, "tx", "ty"]).where("apart < bpart").drop("tx", "ty")
    ax, ay, bx, by = F.col("ax2") - F.col("ax1"), F.col("ay2") - F.col("ay1"), F.col("bx2") - F.col("bx1"), F.col("by2") - F.col("by1")
    gx, gy, turn = F.col("bx1") - F.col("ax1"), F.col("by1") - F.col("ay1"), ax * by - ay * bx
    t, u = (gx * by - gy * bx) / turn, (gx * ay - gy * ax) / turn
    near = 10.0 ** (-2 * digits)
    beside = lambda c: (F.least(f"a{c}1", f"a{c}2") <= F.greatest(f"b{c}1", f"b{c}2") + 10.0**-digits) & (F.least(f"b{c}1", f"b{c}2") <= F.greatest(f"a{c}1", f"a{c}2") + 10.0**-digits)
    met = met.where(beside("x") & beside("y"))
    point = lambda x, y: F.struct(F.round(x, digits).alias("x"), F.round(y, digits).alias("y"))

    def ends_on(p: str, s: str) -> Column:
        """Ends of one edge that lie on the other."""
        on = [(point(F.col(f"{p}x{i}"), F.col(f"{p}y{i}")), segment_distance2(F.col(f"{p}x{i}"), F.col(f"{p}y{i}"), *[F.col(s + k) for k in ("x1", "y1", "x2", "y2")]) <= near) for i in (1, 2)]
        return F.filter(F.array(*[F.when(c, v) for v, c in on]), lambda v: v.isNotNull())

    crossing = F.when((turn != 0) & t.between(0, 1) & u.between(0, 1), F.array(point(F.col("ax1") + t * ax, F.col("ay1") + t * ay)))
    touched = met.withColumn("on_a", ends_on("b", "a")).withColumn("on_b", ends_on("a", "b")).withColumn("x", F.when((F.size("on_a") == 0) & (F.size("on_b") == 0), crossing))
    some = lambda c: F.concat(F.col(f"on_{c}"), F.coalesce("x", F.slice(f"on_{c}", 1, 0)))
    two = F.explode(F.array(*[F.struct(F.col(f"{c}part").alias("part"), F.col(f"{c}edge").alias("edge"), some(c).alias("p")) for c in "ab"])).alias("k")
    return touched.select(key, two).select(key, "k.part", "k.edge", F.explode("k.p").alias("p")).select(key, "part", "edge", "p.x", "p.y")


def _few_simple(each: DataFrame, key: str, digits: int) -> DataFrame:
    """union_boundary() of keys with a few polygons of one ring each: a task takes the polygons of many keys at once."""
    corners = lambda k: F.get("rings", F.lit(0))[k].cast("array<double>")
    rows = each.where(F.size(F.get("rings", F.lit(0))) >= 3).sortWithinPartitions(key, "part").select(key, corners("x").alias("xs"), corners("y").alias("ys"))
    return rows.mapInArrow(boundaries(digits), f"{key} {each.schema[key].dataType.simpleString()}, x1 double, y1 double, x2 double, y2 double")


def union_boundary(polygons: DataFrame, tile: float, key: str = "case_id", digits: int = 6) -> DataFrame:
    """(key, x1, y1, x2, y2): the boundary of the union of each key's polygons (rings), as edges with the inside on their left.

    Edges are cut where they meet those of the key's other polygons; a piece stays unless its middle lies within another polygon. Pieces that
    two polygons have in common stay once, or not at all if the polygons lie on either side of it. Cuts are rounded to `digits` decimals. Polygons
    must not cross themselves; null ones, rings of fewer than three points and repeated ones add nothing. Keys of FEW corners or less, in polygons of one ring with all places known,
    are each one task's; the others' edges meet on common tiles, whose base in near_points() is `tile`.
    """
    known = polygons.where(F.col("rings").isNotNull() & F.col(key).isNotNull())
    each = once(known.select(key, "rings").repartition(key).distinct().withColumn("part", F.xxhash64("rings")))
    ring = F.get("rings", F.lit(0))
    # NaN is the largest value; array_contains() is null, not false, where a place is not known.
    held = lambda v: ~F.array_contains(v, F.lit(1e12)) & (F.array_max(v) < 1e12) & (F.array_min(v) > -1e12)
    simple = (F.size("rings") == 1) & held(ring.x.cast("array<double>")) & held(ring.y.cast("array<double>"))
    corners = F.when(simple, F.size(ring)).otherwise(FEW + 1)
    others = once(each.groupBy(key).agg(F.sum(corners).alias("corners")).where(f"corners > {FEW}").select(key))
    if others.isEmpty():
        return _few_simple(each, key, digits)
    # No broadcast: all keys may be others.
    few = _few_simple(each.join(others.hint("merge"), key, "left_anti").repartition(key), key, digits)
    return few.unionByName(_on_tiles(each.join(others.hint("merge"), key, "left_semi"), tile, key, digits))


def _on_tiles(each: DataFrame, tile: float, key: str, digits: int) -> DataFrame:
    """union_boundary() of any keys; `each` polygon comes once, numbered by `part`."""
    each = once(each)
    edges = each.select(key, "part", F.posexplode(_turned(F.col("rings"))).alias("edge", "e")).select(key, "part", "edge", *[F.round(f"e.{k}", digits).alias(k) for k in ("x1", "y1", "x2", "y2")])
    edges = edges.where("x1 != x2 or y1 != y2")
    ends = [edges.select(key, "part", "edge", F.col(f"x{i}").alias("x"), F.col(f"y{i}").alias("y")) for i in (1, 2)]
    points = ends[0].unionByName(ends[1]).unionByName(_cuts(edges, key, digits)).distinct().join(edges, [key, "part", "edge"])
    along = Window.partitionBy(key, "part", "edge").orderBy((F.col("x") - F.col("x1")) * (F.col("x2") - F.col("x1")) + (F.col("y") - F.col("y1")) * (F.col("y2") - F.col("y1")), "x", "y")
    pieces = points.select(key, "part", F.struct("x", "y").alias("p"), F.lead(F.struct("x", "y")).over(along).alias("q")).where("q is not null")
    ahead = F.col("p") < F.col("q")
    lines = pieces.groupBy(key, F.least("p", "q").alias("lo"), F.greatest("p", "q").alias("hi")).agg(F.bool_or(ahead).alias("ahead"), F.bool_or(~ahead).alias("back"), F.collect_set("part").alias("parts"))
    lines = once(lines.where("not (ahead and back)"))
    x, y = (F.col("lo.x") + F.col("hi.x")) / 2, (F.col("lo.y") + F.col("hi.y")) / 2
    middles = lines.select(key, "lo", "hi", "parts", x.alias("x"), y.alias("y"))
    counted = each.withColumn("few", F.count("*").over(Window.partitionBy(key)) <= FEW // 4)
    box = with_bounds(counted.where("few").drop("few"))
    by_key = middles.join(box.hint("merge"), key).where("x between xmin and xmax and y between ymin and ymax").drop("xmin", "ymin", "xmax", "ymax")
    near = by_key.unionByName(near_points(middles, counted.where("not few").drop("few"), tile, "part", (key,)))
    hidden = near.where(~F.array_contains("parts", F.col("part"))).where(strictly_within(F.col("x"), F.col("y"), edges_of(F.col("rings"))))
    left = lines.join(hidden.select(key, "lo", "hi").distinct(), [key, "lo", "hi"], "left_anti")
    p, q = F.when(F.col("ahead"), F.col("lo")).otherwise(F.col("hi")), F.when(F.col("ahead"), F.col("hi")).otherwise(F.col("lo"))
    return left.select(key, p.alias("p"), q.alias("q")).select(key, F.col("p.x").alias("x1"), F.col("p.y").alias("y1"), F.col("q.x").alias("x2"), F.col("q.y").alias("y2"))


def union_area(boundary: DataFrame, key: str = "case_id") -> DataFrame:
    """(key, area, length, edges) of union_boundary()'s edges; holes count against the area."""
    twice = F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")
    return boundary.groupBy(key).agg((F.sum(twice) / 2).alias("area"), F.sum(F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))).alias("length"), F.count("*").alias("edges"))
