"""Rasters as tables of cells: alignment, resampling, edges, masks. Row 0 is the northern row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from ..functions.geometry import edges_of, polygon_cells, polygon_spans, with_bounds
from ..functions.projections import utm_inverse
from .reports import safe_divide


def grown_bounds(df: DataFrame, factor: float = config.BBOX_FACTOR) -> DataFrame:
    """Bounds moved out on each side by factor times half their extent."""
    dx, dy = factor * (F.col("xmax") - F.col("xmin")) / 2, factor * (F.col("ymax") - F.col("ymin")) / 2
    return df.withColumns({"xmin": F.col("xmin") - dx, "xmax": F.col("xmax") + dx, "ymin": F.col("ymin") - dy, "ymax": F.col("ymax") + dy})


def cell_of(x: Column, y: Column, xll: Column | float, ymax: Column | float, cell: Column | float) -> tuple[Column, Column]:
    """(row, column) of a place."""
    return F.floor((ymax - y) / cell).cast("long"), F.floor((x - xll) / cell).cast("long")


def centre_of(row: Column, col: Column, xll: Column | float, ymax: Column | float, cell: Column | float) -> tuple[Column, Column]:
    return xll + (col + 0.5) * cell, ymax - (row + 0.5) * cell


def with_places(cells: DataFrame, grids: DataFrame, south: bool = False) -> DataFrame:
    """cells with x, y, lon and lat of their centres, on each case's grid (case_id, xll, ymax, cell, zone) in UTM; rows of a case without a grid have nulls."""
    x, y = centre_of(F.col("row_no"), F.col("col_no"), F.col("xll"), F.col("ymax"), F.col("cell"))
    at = cells.join(grids.select("case_id", "xll", "ymax", "cell", "zone"), "case_id", "left").withColumns({"x": x, "y": y})
    lon, lat = utm_inverse(F.col("x"), F.col("y"), F.col("zone"), south)
    return at.withColumns({"lon": lon, "lat": lat}).drop("xll", "ymax", "cell", "zone")


def to_null(value: Column, nodata: float = config.NODATA) -> Column:
    """A cell value with nodata and NaN as null."""
    return F.when(~F.isnan(value.cast("double")) & (value != nodata), value)


def split_bands(bands: DataFrame, layers: DataFrame) -> DataFrame:
    """Cells of a stack under their layer's name; bands without a name go."""
    return bands.join(layers, "band")  # a name per band


def missing_bands(bands: DataFrame, layers: DataFrame) -> DataFrame:
    """(case_id, band, layer): named bands that a case's stack lacks."""
    wanted = bands.select("case_id").distinct().withColumn("l", F.explode(F.array(*[F.struct(F.lit(r.band).alias("band"), F.lit(r.layer).alias("layer")) for r in layers.collect()])))
    return wanted.select("case_id", "l.band", "l.layer").join(bands.select("case_id", "band").distinct(), ["case_id", "band"], "left_anti")


def constant_layers(dem: DataFrame, layers: tuple[str, ...] = ("adj", "phi"), value: float = 1.0) -> DataFrame:
    """A cell of each layer for each cell of the elevation grid."""
    return dem.select("case_id", "row_no", "col_no").withColumn("layer", F.explode(F.array(*map(F.lit, layers)))).withColumn("value", F.lit(value))


def zonal_means(cells: DataFrame, zone: str = "fuel", values: tuple[str, ...] = ("m1", "m10", "m100")) -> DataFrame:
    """(case_id, zone, n, mean of each value) over cells where zone and all values are there."""
    rows = cells.dropna(subset=[zone, *values])
    return rows.groupBy("case_id", zone).agg(F.count("*").alias("n"), *[F.avg(v).alias(f"mean_{v}") for v in values])


def moisture_lines(means: DataFrame, zone: str = "fuel", live: tuple[int, int] = (60, 90)) -> DataFrame:
    """(case_id, fuel, m1, m10, m100, live_herb, live_wood) as whole numbers, with a line for fuel 0 that repeats the lowest class."""
    whole = [F.bround(f"mean_{v}").cast("long").alias(v) for v in ("m1", "m10", "m100")]
    lines = means.select("case_id", F.col(zone).cast("long").alias("fuel"), *whole, F.lit(live[0]).alias("live_herb"), F.lit(live[1]).alias("live_wood"))
    first = lines.withColumn("nth", F.row_number().over(Window.partitionBy("case_id").orderBy("fuel"))).where("nth = 1").drop("nth")
    return first.withColumn("fuel", F.lit(0).cast("long")).unionByName(lines)


def nearest_valid(cells: DataFrame, starts: DataFrame, value: str = "fuel", least: float = config.FIRST_FUEL, most_radius: int = config.MAX_SNAP_RADIUS) -> DataFrame:
    """(case_id, row_no, col_no, moved): each start cell (row0, col0), or the valid cell in the nearest square ring around it, then nearest, then first by row and column.

    The start is clamped to its case's grid. Cases without a valid cell within most_radius have nulls.
    """
    size = cells.groupBy("case_id").agg(F.min("row_no").alias("r_lo"), F.max("row_no").alias("r_hi"), F.min("col_no").alias("c_lo"), F.max("col_no").alias("c_hi"))
    at = starts.join(size, "case_id", "left").withColumn("row0", F.greatest("r_lo", F.least("r_hi", "row0"))).withColumn("col0", F.greatest("c_lo", F.least("c_hi", "col0"))).select("case_id", "row0", "col0")
    near = cells.where(F.col(value) >= least).join(at, "case_id").withColumn("dr", F.abs(F.col("row_no") - F.col("row0"))).withColumn("dc", F.abs(F.col("col_no") - F.col("col0")))
    ring = F.greatest("dr", "dc")
    best = near.where(ring <= most_radius).groupBy("case_id").agg(F.min(F.struct(ring.alias("ring"), (F.col("dr") * F.col("dr") + F.col("dc") * F.col("dc")).alias("d2"), "row_no", "col_no")).alias("b"))
    return at.join(best, "case_id", "left").select("case_id", F.col("b.row_no").alias("row_no"), F.col("b.col_no").alias("col_no"), (F.col("b.ring") > 0).alias("moved"))


#: A grid's west edge, north edge, cell width, rows and columns.
Grid = tuple[float, float, float, int, int]


def coarsened(grid: Grid, factor: int = 4) -> Grid:
    """The grid from the same north-west corner with cells `factor` times as wide, as many as cover the whole of it."""
    xll, ymax, size, rows, cols = grid
    return xll, ymax, size * factor, -(-rows // factor), -(-cols // factor)


def _wanted(cells: DataFrame, source: Grid, target: Grid) -> DataFrame:
    """Every cell of the target in each band, with its centre in rows and columns of the source, counted from the source's first centre."""
    (xll, ymax, size, _, _), (t_xll, t_ymax, t_size, rows, cols) = source, target
    out = cells.select("case_id", "band").distinct().withColumn("row_no", F.explode(F.sequence(F.lit(0), F.lit(rows - 1)))).withColumn("col_no", F.explode(F.sequence(F.lit(0), F.lit(cols - 1))))
    return out.withColumn("fr", (ymax - (t_ymax - (F.col("row_no") + 0.5) * t_size)) / size - 0.5).withColumn("fc", ((t_xll + (F.col("col_no") + 0.5) * t_size) - xll) / size - 0.5)


def _source(cells: DataFrame) -> DataFrame:
    return cells.select("case_id", "band", F.col("row_no").cast("long").alias("r"), F.col("col_no").cast("long").alias("c"), "value")


def nearest_grid(cells: DataFrame, source: Grid, target: Grid) -> DataFrame:
    """Cells of the target grid, each with the source value at its centre, null outside the source. The grids may differ in origin and cell width."""
    at = _wanted(cells, source, target).withColumn("r", F.floor(F.col("fr") + 0.5).cast("long")).withColumn("c", F.floor(F.col("fc") + 0.5).cast("long"))
    return at.join(_source(cells), ["case_id", "band", "r", "c"], "left").select("case_id", "band", "row_no", "col_no", "value")


def bilinear_grid(cells: DataFrame, source: Grid, target: Grid) -> DataFrame:
    """As nearest_grid, with the mean of the four cells around the centre, weighted by nearness; those without a value do not count."""
    corners = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1)])).alias("k")
    four = _wanted(cells, source, target).select("*", corners).withColumn("r", (F.floor("fr") + F.col("k.i")).cast("long")).withColumn("c", (F.floor("fc") + F.col("k.j")).cast("long"))
    weight = (1 - F.abs(F.col("fr") - F.col("r"))) * (1 - F.abs(F.col("fc") - F.col("c")))
    met = four.join(_source(cells).where("value is not null"), ["case_id", "band", "r", "c"]).withColumn("w", weight).where("w > 0")
    return met.groupBy("case_id", "band", "row_no", "col_no").agg((F.sum(F.col("w") * F.col("value")) / F.sum("w")).alias("value"))


def aligned_layers(layers: DataFrame, names: tuple[str, ...], nodata: float = -9999.0) -> DataFrame:
    """(case_id, row_no, col_no, names): the cells at which every layer of (case_id, layer, row_no, col_no, value) has a value, one column for each layer."""
    some = layers.where(F.col("value").isNotNull() & ~F.isnan(F.col("value").cast("double")) & (F.col("value") != nodata))
    return some.groupBy("case_id", "row_no", "col_no").pivot("layer", list(names)).agg(F.first("value")).dropna(subset=list(names))


def fit_to_reference(cells: DataFrame, rows: int, cols: int) -> DataFrame:
    """Each band cut or padded to rows x cols from its south-west corner; padding repeats the northern row and the eastern column."""
    size = cells.groupBy("case_id", "band").agg((F.max("row_no") + 1).alias("nrows"), (F.max("col_no") + 1).alias("ncols"))
    wanted = size.withColumn("row_no", F.explode(F.sequence(F.lit(0), F.lit(rows - 1)))).withColumn("col_no", F.explode(F.sequence(F.lit(0), F.lit(cols - 1))))
    src = wanted.withColumn("r", F.greatest(F.col("row_no") - (rows - F.col("nrows")), F.lit(0)).cast("long")).withColumn("c", F.least(F.col("col_no"), F.col("ncols") - 1).cast("long"))
    source = cells.select("case_id", "band", F.col("row_no").cast("long").alias("r"), F.col("col_no").cast("long").alias("c"), "value")
    return src.join(source, ["case_id", "band", "r", "c"], "left").select("case_id", "band", "row_no", "col_no", "value")


def empty_lines(cells: DataFrame) -> DataFrame:
    """(case_id, axis, line): rows and columns without a value in any band."""
    out = []
    for axis in ("row", "col"):
        lines = cells.groupBy("case_id", F.col(f"{axis}_no").alias("line")).agg(F.bool_and(F.col("value").isNull()).alias("empty"))
        out.append(lines.where("empty").select("case_id", F.lit(axis).alias("axis"), "line"))
    return out[0].unionByName(out[1])


def fill_edges(cells: DataFrame) -> DataFrame:
    """Cells with empty northern rows and eastern columns filled from the nearest row or column that has values."""
    some = cells.where("value is not null").groupBy("case_id").agg(F.min("row_no").alias("first_row"), F.max("col_no").alias("last_col"))
    at = cells.select("case_id", "band", "row_no", "col_no").join(some, "case_id").withColumn("r", F.greatest("row_no", "first_row")).withColumn("c", F.least("col_no", "last_col"))
    source = cells.select("case_id", "band", F.col("row_no").alias("r"), F.col("col_no").alias("c"), "value")
    return at.join(source, ["case_id", "band", "r", "c"], "left").select("case_id", "band", "row_no", "col_no", "value")


def band_counts(wind: DataFrame, moisture: DataFrame, weather: DataFrame, conditioning: int = config.CONDITIONING_HOURS) -> DataFrame:
    """(case_id, ws, m1, fire_rows, status) of each case that has any: distinct bands of two stacks, weather rows after the conditioning hours, and OK or the difference.

    A stack that a case lacks counts null, and then there is no status.
    """
    bands = lambda df, to: df.groupBy("case_id").agg(F.count_distinct("band").alias(to))
    rows = weather.groupBy("case_id").agg(F.greatest(F.lit(0), F.count("*") - conditioning).alias("fire_rows"))
    both = bands(wind, "ws").join(bands(moisture, "m1"), "case_id", "full").join(rows, "case_id", "full")
    diff = F.col("m1") - F.col("ws")
    return both.select("case_id", "ws", "m1", "fire_rows", F.when(diff == 0, "OK").when(diff.isNotNull(), F.format_string("MISMATCH (diff=%+d)", diff)).alias("status"))


def polygon_mask(polygons: DataFrame, xll: float, ymax: float, cell: float, rows: int, cols: int, key: str = "perim_idx") -> DataFrame:
    """(key, row_no, col_no) of the cells whose centre lies within each polygon, a scanline at a time.

    Edges are taken as half open from their lower end, so a centre line through a corner meets it once. A cell whose centre is on the left of a span is in it.
    """
    lines = with_bounds(polygons).withColumn("row_no", F.explode(F.sequence(F.greatest(F.lit(0), F.floor((ymax - F.col("ymax")) / cell).cast("int")), F.least(F.lit(rows - 1), F.floor((ymax - F.col("ymin")) / cell).cast("int")))))
    y = ymax - (F.col("row_no") + 0.5) * cell
    crossing = F.filter(edges_of(F.col("rings")), lambda e: (F.least(e.y1, e.y2) <= y) & (F.greatest(e.y1, e.y2) > y))
    xs = F.array_sort(F.transform(crossing, lambda e: e.x1 + (y - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1)))
    spans = _spans(lines, xs, key)
    first = F.greatest(F.lit(0), F.floor((F.col("a") - xll) / cell - 0.5).cast("int") + 1)
    last = F.least(F.lit(cols - 1), F.ceil((F.col("b") - xll) / cell - 0.5).cast("int") - 1)
    return spans.withColumn("first", first).withColumn("last", last).where("first <= last").select(key, "row_no", F.explode(F.sequence("first", "last")).alias("col_no"))


def _spans(lines: DataFrame, xs: Column, key: str) -> DataFrame:
    """(key, row_no, a, b): the stretches of each line between its odd and even crossings."""
    crossed = lines.select(key, "row_no", xs.alias("xs")).where("size(xs) >= 2")
    return crossed.select(key, "row_no", F.posexplode("xs").alias("i", "a"), "xs").where("i % 2 = 0").withColumn("b", F.element_at("xs", F.col("i") + 2)).drop("xs", "i")


def overlap(observed: DataFrame, simulated: DataFrame, cell: float, key: str = "case_id") -> DataFrame:
    """(key, u, v, observed, simulated): the domain of each case, cells whose centre lies in an observed or a simulated polygon of it."""
    flags = [polygon_cells(df, cell, key).withColumn("observed", F.lit(a)).withColumn("simulated", F.lit(not a)) for df, a in ((observed, True), (simulated, False))]
    return flags[0].unionByName(flags[1]).groupBy(key, "u", "v").agg(F.max("observed").alias("observed"), F.max("simulated").alias("simulated"))


def polygon_scores(observed: DataFrame, simulated: DataFrame, cell: float, key: str = "case_id") -> DataFrame:
    """(key, na, nb, n_both, jaccard, sorensen, kappa, ratio_of_areas) of each case's observed against its simulated polygons.

    The union is the domain, so nothing is true negative. A case may have several polygons; their cells count once. A case without one side scores 0.
    """
    of = lambda c: F.count_if(c)
    out = overlap(observed, simulated, cell, key).groupBy(key).agg(of(F.col("observed")).alias("na"), of(F.col("simulated")).alias("nb"), of(F.col("observed") & F.col("simulated")).alias("n_both"))
    either = F.col("na") + F.col("nb") - F.col("n_both")
    chance = (F.col("na") * F.col("nb") + (either - F.col("na")) * (either - F.col("nb"))) / (either * either)
    return out.withColumns({"jaccard": safe_divide(F.col("n_both"), either), "sorensen": safe_divide(2.0 * F.col("n_both"), F.col("na") + F.col("nb")), "kappa": safe_divide(F.col("n_both") / either - chance, 1 - chance), "ratio_of_areas": safe_divide(F.col("nb"), F.col("na"))})


def dissolved(polygons: DataFrame, cell: float, key: str = "case_id") -> DataFrame:
    """(key, rings, xmin, ymin, xmax, ymax, area): all rings of a key together, their bounds, and the area of their union as cells, overlaps counted once."""
    bounds = with_bounds(polygons).groupBy(key).agg(F.flatten(F.collect_list("rings")).alias("rings"), *[f(c).alias(c) for c, f in (("xmin", F.min), ("ymin", F.min), ("xmax", F.max), ("ymax", F.max))])
    # Of each run the cells beyond those of the runs before it, so runs are sorted and not taken apart.
    before = Window.partitionBy(key, "v").orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1)
    new = F.greatest(F.lit(0), F.col("last") - F.greatest(F.col("first"), F.coalesce(F.max("last").over(before) + 1, F.col("first"))) + 1)
    cells = polygon_spans(polygons, cell, key).select(key, new.alias("cells")).groupBy(key).agg((F.sum("cells") * cell * cell).alias("area"))
    return bounds.join(cells, key, "left")
