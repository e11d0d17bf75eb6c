"""The nearest of many points, by a tree of tiles whose bounds rule out all but a few."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Tiles of one level lie BRANCH x BRANCH in a tile of the next.
BRANCH = 8

#: A level of at most this many tiles is small enough to send to every task: BRANCH**2 below the root, and that squared one further down.
SENT = BRANCH**4


def _square(v: Column) -> Column:
    return v * v


def _levels(grid: DataFrame, base: float | None) -> tuple[float, float, float, int]:
    """West and south edge of all points, width of a leaf, and the number of levels from the leaves to the one tile that holds them all."""
    e = grid.agg(F.min("lon").alias("x0"), F.min("lat").alias("y0"), F.max("lon").alias("x1"), F.max("lat").alias("y1"), F.count("*").alias("n")).first()
    if not e.n:
        return 0.0, 0.0, 1.0, 1
    wide = max(e.x1 - e.x0, e.y1 - e.y0)
    if wide == 0:
        return e.x0, e.y0, 1.0, 1
    leaf = base or 4 * wide / math.sqrt(e.n)  # some 16 points a leaf if they lie evenly
    return e.x0, e.y0, leaf, max(1, math.ceil(math.log(wide / leaf + 1, BRANCH)))


def near_leaves(grid: DataFrame, places: DataFrame, base: float | None = None) -> tuple[DataFrame, DataFrame, list[str]]:
    """Points with their leaf, each place with the leaves that may hold its nearest point, and the columns that the two share.

    From the root down, a place keeps those tiles whose points may lie no farther than the farthest corner of the best of them, which some point does not exceed.
    The number of levels grows with the logarithm of the points, and a place keeps a few tiles of each.
    """
    own = ["case_id"] if "case_id" in grid.columns else []
    known = grid.select(*own, "point_id", F.col("lon").cast("double").alias("lon"), F.col("lat").cast("double").alias("lat")).where("lon is not null and lat is not null and not isnan(lon) and not isnan(lat)")
    x0, y0, leaf, levels = _levels(known, base)
    at = lambda c, start: F.floor((F.col(c) - start) / leaf).cast("long")
    points = known.withColumn("tx", at("lon", x0)).withColumn("ty", at("lat", y0))
    ends = {"xmin": F.min, "xmax": F.max, "ymin": F.min, "ymax": F.max}
    tiles = [points.groupBy(*own, "tx", "ty").agg(F.min("lon").alias("xmin"), F.max("lon").alias("xmax"), F.min("lat").alias("ymin"), F.max("lat").alias("ymax"))]
    up = lambda c: F.floor(F.col(c) / BRANCH).cast("long").alias(c)
    for _ in range(1, levels):
        tiles.append(tiles[-1].groupBy(*own, up("tx"), up("ty")).agg(*[f(c).alias(c) for c, f in ends.items()]))
    kept = places.where("lon0 is not null and lat0 is not null and not isnan(lon0) and not isnan(lat0)").select("case_id", F.col("lon0").cast("double").alias("lon0"), F.col("lat0").cast("double").alias("lat0"), F.lit(0).cast("long").alias("px"), F.lit(0).cast("long").alias("py"))
    off = lambda v, lo, hi: F.greatest(F.col(lo) - F.col(v), F.col(v) - F.col(hi), F.lit(0.0))
    far = lambda v, lo, hi: F.greatest(F.abs(F.col(v) - F.col(lo)), F.abs(F.col(v) - F.col(hi)))
    for depth, level in enumerate(reversed(tiles)):
        below = level.withColumn("px", F.floor(F.col("tx") / BRANCH).cast("long")).withColumn("py", F.floor(F.col("ty") / BRANCH).cast("long"))
        if not own and BRANCH ** (2 * depth + 2) <= SENT:
            below = F.broadcast(below)
        met = kept.join(below, [*own, "px", "py"])
        met = met.withColumn("least", _square(off("lon0", "xmin", "xmax")) + _square(off("lat0", "ymin", "ymax"))).withColumn("most", _square(far("lon0", "xmin", "xmax")) + _square(far("lat0", "ymin", "ymax")))
        few = met.groupBy("case_id", "lon0", "lat0").agg(F.min("most").alias("bound"), F.collect_list(F.struct("least", "tx", "ty")).alias("t"))
        kept = few.select("case_id", "lon0", "lat0", F.explode(F.filter("t", lambda x: x.least <= F.col("bound"))).alias("k")).select("case_id", "lon0", "lat0", F.col("k.tx").alias("px"), F.col("k.ty").alias("py"))
    return points, kept.withColumnsRenamed({"px": "tx", "py": "ty"}), [*own, "tx", "ty"]


def nearest_point(grid: DataFrame, places: DataFrame, base: float | None = None) -> DataFrame:
    """(case_id, point_id, d2): the grid point (point_id, lon, lat) nearest to each place (case_id, lon0, lat0), ties to smaller ids.

    With a case_id the grid is that case's, else all places share it. `base` is the width of the least tiles, by default one that holds some 16 evenly spread points.
    Places and points without coordinates take no part; a place without points has no row.
    """
    points, kept, keys = near_leaves(grid, places, base)
    d2 = _square(F.col("lon") - F.col("lon0")) + _square(F.col("lat") - F.col("lat0"))
    best = kept.join(points, keys).groupBy("case_id").agg(F.min(F.struct(d2.alias("d2"), "point_id")).alias("b"))
    return best.select("case_id", F.col("b.point_id").alias("point_id"), F.col("b.d2").alias("d2"))
