"""Plane geometry in column expressions. A polygon is an array of rings, a ring an array of points (x, y); edges are structs of doubles x1, y1, x2, y2."""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..folders import let_go, once


def edges_of(rings: Column) -> Column:
    """The edges of all rings, each ring closed."""

    def of(ring: Column) -> Column:
        after = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
        return F.zip_with(ring, after, lambda a, b: F.struct(a.x.cast("double").alias("x1"), a.y.cast("double").alias("y1"), b.x.cast("double").alias("x2"), b.y.cast("double").alias("y2")))

    return F.flatten(F.transform(rings, of))


def strictly_within(x: Column, y: Column, edges: Column) -> Column:
    """Inside by the even-odd rule and on no edge; holes are rings like others."""
    on_edge = F.exists(
        edges,
        lambda e: ((e.x2 - e.x1) * (y - e.y1) == (e.y2 - e.y1) * (x - e.x1)) & x.between(F.least(e.x1, e.x2), F.greatest(e.x1, e.x2)) & y.between(F.least(e.y1, e.y2), F.greatest(e.y1, e.y2)),
    )
    crossed = F.filter(edges, lambda e: ((e.y1 > y) != (e.y2 > y)) & (x < (e.x2 - e.x1) * (y - e.y1) / (e.y2 - e.y1) + e.x1))
    return (F.size(crossed) % 2 == 1) & ~on_edge


def shoelace(edges: Column) -> Column:
    """Area inside the rings; holes run the other way round."""
    return F.abs(F.aggregate(edges, F.lit(0.0), lambda s, e: s + (e.x1 * e.y2 - e.x2 * e.y1))) / 2


def with_bounds(df: DataFrame, rings: str = "rings") -> DataFrame:
    """df with xmin, ymin, xmax, ymax of its polygons."""
    points = F.flatten(F.col(rings))
    ends = {"xmin": F.array_min(F.transform(points, lambda p: p.x)), "ymin": F.array_min(F.transform(points, lambda p: p.y)), "xmax": F.array_max(F.transform(points, lambda p: p.x)), "ymax": F.array_max(F.transform(points, lambda p: p.y))}
    return df.withColumns({k: v.cast("double") for k, v in ends.items()})


def tile(v: Column, size: float) -> Column:
    return F.floor(v / size).cast("long")


def with_tiles(df: DataFrame, size: float, grow: float = 0.0) -> DataFrame:
    """A row for each tile (tx, ty) that the bounds, grown on all sides, touch."""
    span = lambda lo, hi: F.explode(F.sequence(tile(F.col(lo) - grow, size), tile(F.col(hi) + grow, size)))
    return df.withColumn("tx", span("xmin", "xmax")).withColumn("ty", span("ymin", "ymax"))


#: Polygons of this many points or fewer take their rings along to the tiles.
SMALL_RINGS = 64


def near_points(points: DataFrame, polygons: DataFrame, base: float, key: str = "perim_idx", same: tuple[str, ...] = (), across: int = 3, shape: tuple[str, ...] = ("rings",)) -> DataFrame:
    """Pairs of a point (x, y) and a polygon (rings) whose bounds hold it.

    A polygon lies on tiles of base * 2**level, at the least level at which its bounds are no wider than `across` of them: (across + 1)**2 tiles at most,
    however large it is. A point meets each level that some polygon has. Rings of more than SMALL_RINGS points, and other columns of `shape`, come to the pairs by the polygons' unique `key`.
    Points and polygons without a place meet nothing. Column names must not clash, but for those of `same`, in which a pair is equal; `key` is unique within them.
    """
    boxes = with_bounds(polygons).where("xmin is not null and ymin is not null")
    wide = F.greatest(F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin")) / (float(across) * base)
    boxes = boxes.withColumn("level", F.when(wide > 1, F.ceil(F.log2(wide))).otherwise(0).cast("int"))
    levels = sorted(r.level for r in boxes.select("level").distinct().collect())  # one for each doubling of size
    at = lambda v: F.floor(v / (base * F.pow(F.lit(2.0), "level"))).cast("long")
    placed = points.withColumn("level", F.explode(F.array(*map(F.lit, levels or [0])).cast("array<int>"))).withColumn("tx", at(F.col("x"))).withColumn("ty", at(F.col("y")))
    span = lambda lo, hi: F.explode(F.sequence(at(F.col(lo)), at(F.col(hi))))
    tiled = boxes.withColumn("tx", span("xmin", "xmax")).withColumn("ty", span("ymin", "ymax"))
    inside = F.col("x").between(F.col("xmin"), F.col("xmax")) & F.col("y").between(F.col("ymin"), F.col("ymax"))
    small = F.size(F.flatten("rings")) <= SMALL_RINGS
    # Sizes are estimated without the rows that tiles add, so a broadcast could be far larger than it looks.
    met = lambda some: placed.join(some.hint("merge"), [*same, "level", "tx", "ty"]).where(inside).drop("level", "tx", "ty", "xmin", "ymin", "xmax", "ymax")
    light, heavy = met(tiled.where(small)), met(tiled.where(~small).drop(*shape)).join(polygons.select(*same, key, *shape), [*same, key])
    return light.unionByName(heavy)


def _places_in_shapes(points: DataFrame, polygons: DataFrame, base: float, across: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(x, y, n) of each place of points, (rings, n, shape) of each shape of polygons, and (x, y, shape) where a place lies strictly within a shape: each is tested once, however many points and polygons have them."""
    places = once(points.where("x is not null and y is not null").groupBy("x", "y").agg(F.count("*").alias("n")))
    shapes = once(polygons.where("rings is not null").groupBy("rings").agg(F.count("*").alias("n")).withColumn("shape", F.monotonically_increasing_id()))
    near = near_points(places.select("x", "y"), shapes.select("shape", "rings", edges_of(F.col("rings")).alias("edges")), base, "shape", across=across, shape=("rings", "edges"))
    return places, shapes, near.where(strictly_within(F.col("x").cast("double"), F.col("y").cast("double"), F.col("edges"))).select("x", "y", "shape")


def points_in_polygons(points: DataFrame, polygons: DataFrame, base: float, condition: Column | None = None, key: str = "perim_idx", across: int = 3) -> DataFrame:
    """Pairs of a point (x, y) and a polygon (rings) that it lies strictly within, and for which `condition` holds.

    Each place is tested once against each shape; then come the points, then the polygons, or the other way round, so that the side with more copies comes last and the rows before it are few.
    """
    places, shapes, inside = _places_in_shapes(points, polygons, base, across)
    copies = [df.agg(F.coalesce(F.sum("n") / F.count("*"), F.lit(0.0))).first()[0] for df in (places, shapes)]
    of = polygons.join(shapes.select("rings", "shape"), "rings")
    with_points = lambda df: df.join(points.hint("merge"), ["x", "y"])
    with_polygons = lambda df: df.join(of.hint("merge"), "shape")
    pairs = with_points(with_polygons(inside)) if copies[0] > copies[1] else with_polygons(with_points(inside))
    return (pairs if condition is None else pairs.where(condition)).select(*points.columns, *polygons.columns)


#: Points of one place that are held in one list.
LISTED = 4096


def lists_in_polygons(points: DataFrame, polygons: DataFrame, base: float, key: str = "perim_idx", across: int = 3, to: str = "points", least: int = 50_000_000, each: int = 8) -> Iterator[DataFrame]:
    """points_in_polygons() with the points of a place as lists, of a share of the polygons at a time, all rows of a polygon in one: for pairs that must be shuffled, as their number grows with the square of the tables.

    Rows are the polygons' columns, x, y and `to`, a list of the points' other columns in their order; a place of more than some LISTED points has several rows.
    A share has about `least` pairs, or `each` times as many as there are points, if that is more. At least one share is given.
    """
    places, shapes, inside = _places_in_shapes(points, polygons, base, across)
    inside = once(inside)
    counts = inside.join(places, ["x", "y"]).join(shapes.select("shape", F.col("n").alias("m")), "shape")
    pairs = counts.agg(F.coalesce(F.sum(F.col("n") * F.col("m")), F.lit(0))).first()[0]
    total = places.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    others = [c for c in points.columns if c not in ("x", "y")]
    known = points.join(inside.select("x", "y").distinct().join(places, ["x", "y"]).hint("merge"), ["x", "y"])
    part = F.pmod(F.xxhash64(*others), F.ceil(F.col("n") / LISTED))
    lists = once(known.groupBy("x", "y", part.alias("part")).agg(F.sort_array(F.collect_list(F.struct(*others))).alias(to)).drop("part"))
    of = once(polygons.join(shapes.select("rings", "shape"), "rings"))
    let_go(points.sparkSession)
    rounds = max(1, math.ceil(pairs / max(least, each * total)))
    for i in range(rounds):
        some = inside.join(of.where(F.pmod(F.xxhash64(key), F.lit(rounds)) == i).hint("merge"), "shape")
        yield some.join(lists.hint("merge"), ["x", "y"]).select(*polygons.columns, "x", "y", to)


def polygon_spans(polygons: DataFrame, cell: float, key: str) -> DataFrame:
    """(key, v, first, last): runs of cells of one grid over the plane whose centres lie within a polygon, by scanlines.

    Edges are half open from their lower end, so a line through a corner meets it once. A key may have several polygons: each is filled for itself, so runs may overlap.
    Rings of SMALL_RINGS points or fewer are cut where they are; of larger ones each edge gives its crossings with the rows' centre lines.
    """
    lowest, highest = (lambda e: F.ceil(F.least(e.y1, e.y2) / cell - 0.5)), (lambda e: F.ceil(F.greatest(e.y1, e.y2) / cell - 0.5) - 1)
    at = lambda e, v: e.x1 + ((v + 0.5) * cell - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1)
    small = F.size(F.flatten("rings")) <= SMALL_RINGS
    slanted = F.filter(edges_of(F.col("rings")), lambda e: lowest(e) <= highest(e))
    crossings = F.flatten(F.transform(slanted, lambda e: F.transform(F.sequence(lowest(e), highest(e)), lambda v: F.struct(v.alias("v"), at(e, v).alias("x")))))
    # In order of rows and places, every two crossings are the ends of a run.
    sorted_ = polygons.where(small).select(key, F.array_sort(crossings).alias("c")).where("size(c) > 0")
    light = sorted_.select(key, F.inline(F.expr("transform(sequence(0, size(c) - 2, 2), i -> struct(c[i].v as v, c[i].x as a, c[i + 1].x as b))")))
    each = polygons.where(~small).groupBy(key, F.xxhash64("rings").alias("part")).agg(F.first("rings").alias("rings"))
    long = each.select(key, "part", F.explode(edges_of(F.col("rings"))).alias("e")).where(lowest(F.col("e")) <= highest(F.col("e"))).withColumn("v", F.explode(F.sequence(lowest(F.col("e")), highest(F.col("e")))))
    heavy = long.groupBy(key, "part", "v").agg(F.array_sort(F.collect_list(at(F.col("e"), F.col("v")))).alias("xs")).drop("part")
    heavy = heavy.select(key, "v", F.posexplode("xs").alias("i", "a"), "xs").where("i % 2 = 0").select(key, "v", "a", F.element_at("xs", F.col("i") + 2).alias("b"))
    spans = light.unionByName(heavy)
    first, last = F.floor(F.col("a") / cell - 0.5) + 1, F.ceil(F.col("b") / cell - 0.5) - 1
    return spans.select(key, "v", first.alias("first"), last.alias("last")).where("first <= last")


def polygon_cells(polygons: DataFrame, cell: float, key: str) -> DataFrame:
    """(key, u, v) of the cells of polygon_spans(), each once."""
    return polygon_spans(polygons, cell, key).select(key, F.explode(F.sequence("first", "last")).alias("u"), "v").distinct()


def segment_distance2(px: Column, py: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Squared distance of a point to a segment."""
    dx, dy = x2 - x1, y2 - y1
    length2 = dx * dx + dy * dy
    t = F.when(length2 == 0, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((px - x1) * dx + (py - y1) * dy) / length2)))
    ex, ey = px - (x1 + t * dx), py - (y1 + t * dy)
    return ex * ex + ey * ey


def segments_cross(a: list[Column], b: list[Column]) -> Column:
    """Whether two segments (x1, y1, x2, y2) properly cross."""
    side = lambda s, x, y: (s[2] - s[0]) * (y - s[1]) - (s[3] - s[1]) * (x - s[0])
    return (side(a, b[0], b[1]) * side(a, b[2], b[3]) < 0) & (side(b, a[0], a[1]) * side(b, a[2], a[3]) < 0)


def segments_distance2(a: list[Column], b: list[Column]) -> Column:
    """Squared distance of two segments, 0 if they cross."""
    ends = F.least(segment_distance2(a[0], a[1], *b), segment_distance2(a[2], a[3], *b), segment_distance2(b[0], b[1], *a), segment_distance2(b[2], b[3], *a))
    return F.when(segments_cross(a, b), F.lit(0.0)).otherwise(ends)
