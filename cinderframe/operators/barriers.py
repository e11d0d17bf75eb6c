"""Roads and water as fire barriers: lines of classes with widths, drawn on a grid."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..folders import once
from ..functions.geometry import segment_distance2, segments_cross, segments_distance2, with_tiles

PLACE = ("x1", "y1", "x2", "y2")


def with_widths(segments: DataFrame, widths: DataFrame) -> DataFrame:
    """Segments with their class's width and rank; unknown classes go."""
    return segments.join(widths, ["layer", "class"])


def _bounded(segments: DataFrame) -> DataFrame:
    return segments.withColumns({"xmin": F.least("x1", "x2"), "xmax": F.greatest("x1", "x2"), "ymin": F.least("y1", "y2"), "ymax": F.greatest("y1", "y2")})


def clip(segments: DataFrame, extents: DataFrame, tile: float = 100.0) -> DataFrame:
    """Classed segments whose bounds meet a case's extent (case_id, xmin, ymin, xmax, ymax), once for each such case."""
    left = with_tiles(_bounded(segments.where("class is not null")), tile)
    right = with_tiles(extents, tile).select("case_id", "tx", "ty", *[F.col(k).alias(f"e_{k}") for k in ("xmin", "xmax", "ymin", "ymax")])
    meet = (F.col("xmax") >= F.col("e_xmin")) & (F.col("xmin") <= F.col("e_xmax")) & (F.col("ymax") >= F.col("e_ymin")) & (F.col("ymin") <= F.col("e_ymax"))
    # A pair is counted in the first tile that both cover.
    first = (F.col("tx") == F.floor(F.greatest("xmin", "e_xmin") / tile)) & (F.col("ty") == F.floor(F.greatest("ymin", "e_ymin") / tile))
    return left.join(right, ["tx", "ty"]).where(meet & first).drop("tx", "ty", "e_xmin", "e_xmax", "e_ymin", "e_ymax")


def not_near(backup: DataFrame, primary: DataFrame, tolerance: float = config.BACKUP_TOLERANCE_M, tile: float = 16.0) -> DataFrame:
    """Backup segments farther than tolerance from every primary one; all of them if there is none."""
    # Lines in one place are tested once, and only if their bounds come within tolerance.
    left = with_tiles(_bounded(backup.select(*PLACE).distinct()), tile, tolerance)
    right = with_tiles(_bounded(primary.select(*PLACE).distinct()), tile)
    right = right.select("tx", "ty", *[F.col(k).alias(f"p_{k}") for k in (*PLACE, "xmin", "xmax", "ymin", "ymax")])
    a, b = [F.col(k) for k in PLACE], [F.col(f"p_{k}") for k in PLACE]
    beside = [(F.col(f"p_{c}min") <= F.col(f"{c}max") + tolerance) & (F.col(f"p_{c}max") >= F.col(f"{c}min") - tolerance) for c in "xy"]
    met = lambda lines: lines.join(right.hint("merge"), ["tx", "ty"]).where(beside[0] & beside[1])
    # Most that come near cross, which is told for far less than a distance.
    crossing = once(met(left).where(segments_cross(a, b)).select(*PLACE).distinct())
    rest = once(left.join(crossing, list(PLACE), "left_anti"))
    # What does not cross is as near as the nearest end of one to the other; a row for each end keeps the expression small enough to be compiled.
    ends = [F.struct(*[c.cast("double").alias(k) for k, c in zip(("px", "py", "sx1", "sy1", "sx2", "sy2"), (*p, *s), strict=True)]) for p, s in ((a[:2], b), (a[2:], b), (b[:2], a), (b[2:], a))]
    rows = met(rest).select(*PLACE, F.inline(F.array(*ends)))
    apart2 = segment_distance2(*[F.col(k) for k in ("px", "py", "sx1", "sy1", "sx2", "sy2")])
    near = rows.where(apart2 <= tolerance * tolerance).select(*PLACE).distinct()
    return backup.join(crossing.unionByName(near), list(PLACE), "left_anti").select(backup.columns)


def drawn_once(segments: DataFrame) -> DataFrame:
    """Classed segments with widths; those of one class in one place once, as rasters do not tell them apart."""
    return segments.select(*PLACE, "layer", "class", "width", "class_rank").distinct()


def touched_cells(segments: DataFrame, cell: float, by_centre: bool = False) -> DataFrame:
    """A row for each cell (u, v) that a segment of its width touches; by_centre: whose centre lies in it. Segments of one place and width are drawn once."""
    shapes = _drawn(segments.select(*PLACE, "width").distinct(), cell, by_centre)
    return segments.join(shapes.hint("merge"), [*PLACE, "width"])


def _drawn(segments: DataFrame, cell: float, by_centre: bool) -> DataFrame:
    """(x1, y1, x2, y2, width, u, v) of distinct segments."""
    reach = F.col("width") / 2
    # Row by row along the segment: in each row of cells only the columns beside the part of the segment that comes within reach of the row.
    rows = _bounded(segments).withColumn("v", F.explode(F.sequence(F.floor((F.col("ymin") - reach) / cell), F.floor((F.col("ymax") + reach) / cell))))
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    at = lambda y: F.when(dy == 0, F.lit(None)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), (y - F.col("y1")) / dy)))
    t0, t1 = F.coalesce(at(F.col("v") * cell - reach), F.lit(0.0)), F.coalesce(at((F.col("v") + 1) * cell + reach), F.lit(1.0))
    xa, xb = F.col("x1") + t0 * dx, F.col("x1") + t1 * dx
    near = rows.withColumn("u", F.explode(F.sequence(F.floor((F.least(xa, xb) - reach) / cell), F.floor((F.greatest(xa, xb) + reach) / cell))))
    s = [F.col(k).cast("double") for k in ("x1", "y1", "x2", "y2")]
    if by_centre:
        apart2 = segment_distance2((F.col("u") + 0.5) * cell, (F.col("v") + 0.5) * cell, *s)
    else:
        x0, y0 = F.col("u") * cell, F.col("v") * cell
        corners = [x0, y0, x0 + cell, y0], [x0 + cell, y0, x0 + cell, y0 + cell], [x0 + cell, y0 + cell, x0, y0 + cell], [x0, y0 + cell, x0, y0]
        inside = s[0].between(x0, x0 + cell) & s[1].between(y0, y0 + cell)
        apart2 = F.when(inside, F.lit(0.0)).otherwise(F.least(*[segments_distance2(s, side) for side in corners]))
    return near.where(apart2 <= reach * reach).select(*PLACE, "width", "u", "v")


def barrier_raster(touched: DataFrame) -> DataFrame:
    """(u, v, width): in each layer the class drawn last, over all layers the widest."""
    layers = touched.groupBy("u", "v", "layer").agg(F.max_by("width", "class_rank").alias("width"))
    return layers.groupBy("u", "v").agg(F.max("width").alias("width"))


def on_grid(raster: DataFrame, grid: DataFrame) -> DataFrame:
    """The raster on every cell of a grid, 0 where nothing is."""
    return grid.join(raster, ["u", "v"], "left").withColumn("width", F.coalesce("width", F.lit(0.0)))
