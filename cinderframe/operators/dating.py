"""Dating fires by satellite hotspots: unbroken chains of detections and growing covered area."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from ..folders import once
from ..functions.geometry import edges_of, lists_in_polygons, near_points, points_in_polygons, polygon_spans, shoelace, strictly_within
from ..functions.text import hotspot_time, lenient_timestamp, seconds_between


def with_hotspot_time(hotspots: DataFrame, to: str = "sat_ts") -> DataFrame:
    """Hotspots with their time from date and HHMM columns; those without one go."""
    return hotspots.withColumn(to, hotspot_time(F.col("acq_date"), F.col("acq_time"))).where(F.col(to).isNotNull())


def hotspots_in_burns(hotspots: DataFrame, cases: DataFrame, tile: float = 200.0) -> DataFrame:
    """Hotspots strictly within each case's polygon and not before its discovery."""
    return points_in_polygons(hotspots, cases, tile / 2, F.col("sat_ts") >= F.col("discovery"), across=7)


def listed_in_burns(hotspots: DataFrame, cases: DataFrame, tile: float = 200.0, **sizes: int) -> Iterator[DataFrame]:
    """hotspots_in_burns() of a share of the cases at a time, with the hotspots of a place as lists in column `hotspots`; `sizes` as in lists_in_polygons()."""
    for rows in lists_in_polygons(hotspots.where("sat_ts is not null"), cases, tile / 2, across=7, to="hotspots", **sizes):
        # Most lists begin after the discovery, and need no look at each hotspot.
        all_since = F.array_min(F.col("hotspots.sat_ts")) >= F.col("discovery")
        left = F.when(all_since, F.col("hotspots")).otherwise(F.filter("hotspots", lambda h: h.sat_ts >= F.col("discovery")))
        yield rows.withColumn("hotspots", left).where(F.size("hotspots") > 0)


def chains(detections: DataFrame, gap_days: float = config.CHAIN_GAP_DAYS, start: str | None = None) -> DataFrame:
    """(case_id, chain_start, chain_end, n): the first chain from the time in column `start` on (all times if None), broken by the first gap over gap_days.

    No two times of one span of gap_days are a gap apart, so a case's spans, a few rows that are merged in each task, tell its chains.
    """
    rows = detections if start is None else detections.where(F.col("sat_ts") >= F.col(start))
    limit = int(gap_days * 86400)
    span = F.floor(F.timestamp_diff("SECOND", F.lit("2000-01-01").cast("timestamp_ntz"), F.col("sat_ts")) / limit)
    spans = rows.where("sat_ts is not null").groupBy("case_id", span.alias("span")).agg(F.min("sat_ts").alias("first"), F.max("sat_ts").alias("last"), F.count("*").alias("n"))
    order = Window.partitionBy("case_id").orderBy("span")
    breaks = F.coalesce(seconds_between(F.lag("last").over(order), F.col("first")), F.lit(0)) > limit
    numbered = spans.withColumn("breaks", breaks.cast("int")).withColumn("chain", F.sum("breaks").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return numbered.where("chain = 0").groupBy("case_id").agg(F.min("first").alias("chain_start"), F.max("last").alias("chain_end"), F.sum("n").alias("n"))


def in_first_chain(detections: DataFrame, gap_days: float = config.CHAIN_GAP_DAYS, start: str | None = None) -> DataFrame:
    """The detections of each case's first chain, with its chain_start and chain_end."""
    found = chains(detections, gap_days, start).drop("n")
    return detections.join(found, "case_id").where(F.col("sat_ts").between(F.col("chain_start"), F.col("chain_end")))


def disc_cells(detections: DataFrame, radius: float = config.DISC_RADIUS_M, cell: float = config.COVER_CELL_M, spans: DataFrame | None = None) -> DataFrame:
    """A row for each grid cell (u, v) whose centre lies within radius of a detection; in the case's spans (case_id, v, first, last) only, if they are given.

    Rows of cells come first and meet the spans, then the columns between the ends of each row.
    """
    dx, dy = (F.col("u") + 0.5) * cell - F.col("x"), (F.col("v") + 0.5) * cell - F.col("y")
    rows = detections.withColumn("v", F.explode(F.sequence(F.floor((F.col("y") - radius) / cell), F.floor((F.col("y") + radius) / cell)))).where(dy * dy <= radius * radius)
    half = F.sqrt(radius * radius - dy * dy)
    # A little wider than the row is, as the last word has the exact test.
    left, right = F.ceil((F.col("x") - half) / cell - 0.5 - 1e-6), F.floor((F.col("x") + half) / cell - 0.5 + 1e-6)
    if spans is not None:
        rows = rows.join(spans.hint("merge"), ["case_id", "v"])  # no broadcast: there are far more spans than their estimate says
        left, right = F.greatest(left, "first"), F.least(right, "last")
    near = rows.withColumn("left", left).withColumn("right", right).where("left <= right").withColumn("u", F.explode(F.sequence("left", "right")))
    return near.where(dx * dx + dy * dy <= radius * radius).select(*detections.columns, "u", "v")


def first_seen(detections: DataFrame, radius: float = config.DISC_RADIUS_M, cell: float = config.COVER_CELL_M, spans: DataFrame | None = None) -> DataFrame:
    """(case_id, u, v, sat_ts): when each cell of disc_cells() was first covered. Cells of a task are merged before the shuffle."""
    return disc_cells(detections, radius, cell, spans).groupBy("case_id", "u", "v").agg(F.min("sat_ts").alias("sat_ts"))


def covered_area(detections: DataFrame, radius: float = config.DISC_RADIUS_M, cell: float = config.COVER_CELL_M) -> DataFrame:
    """(case_id, area_m2): area of the union of each case's discs."""
    return first_seen(detections, radius, cell).groupBy("case_id").agg((F.count("*") * cell * cell).alias("area_m2"))


def coverage_curve(detections: DataFrame, radius: float = config.DISC_RADIUS_M, cell: float = config.COVER_CELL_M, burns: DataFrame | None = None) -> DataFrame:
    """(case_id, sat_ts, area_m2): covered area after each time of a detection; within each case's polygon only if burns (case_id, rings) are given."""
    seen = first_seen(detections, radius, cell, None if burns is None else polygon_spans(burns, cell, "case_id"))
    new = seen.groupBy("case_id", "sat_ts").agg(F.count("*").alias("cells"))
    times = detections.groupBy("case_id", "sat_ts").agg(F.lit(0).cast("long").alias("cells"))
    each = new.unionByName(times).groupBy("case_id", "sat_ts").agg(F.sum("cells").alias("cells"))
    upto = Window.partitionBy("case_id").orderBy("sat_ts").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return each.select("case_id", "sat_ts", (F.sum("cells").over(upto) * cell * cell).alias("area_m2"))


def times_to_fractions(curve: DataFrame, detections: DataFrame, fractions: dict[str, float], burn_area_m2: Column | None = None, reached: bool = False) -> DataFrame:
    """(case_id, names of `fractions`): first times at which the area reaches each fraction of the smaller of burn and final area, in one pass over the curve.

    Null if the target is not above 0, unless `reached` counts it as reached at once; the last detection's time if it is never reached. burn_area_m2 is a column of `curve`, no bound if None.
    """
    final = F.max("area_m2").over(Window.partitionBy("case_id"))
    bounded = curve.withColumn("bound", final if burn_area_m2 is None else F.least(final, burn_area_m2))
    hits = [F.min(F.when(F.col("area_m2") >= f * F.col("bound"), F.col("sat_ts"))).alias(k) for k, f in fractions.items()]
    hit = bounded.groupBy("case_id").agg(F.max("bound").alias("bound"), *hits)
    last = detections.groupBy("case_id").agg(F.max("sat_ts").alias("last"))
    return last.join(hit, "case_id", "left").select("case_id", *[F.when(F.lit(reached) | (f * F.col("bound") > 0), F.coalesce(k, "last")).alias(k) for k, f in fractions.items()])


def time_to_fraction(curve: DataFrame, detections: DataFrame, fraction: float, burn_area_m2: Column | None = None, to: str = "reached") -> DataFrame:
    """times_to_fractions() of one fraction."""
    return times_to_fractions(curve, detections, {to: fraction}, burn_area_m2)


def event_end(satellite_end: Column, fireout: Column) -> Column:
    """The earlier of satellite end and fire-out; fire-out may be null, satellite end must not."""
    return F.when(satellite_end.isNotNull(), F.least(satellite_end, fireout))


def report_end(detections: DataFrame, cases: DataFrame, gap_days: float = config.CHAIN_GAP_DAYS, fraction: float = config.END_FRACTION) -> tuple[DataFrame, DataFrame]:
    """(curve, ends) as the report has them: cover of the first chain from each case's discovery, clipped to its burn; ends: case_id and sat_end, when it reaches `fraction` of the smaller of burn and final cover.

    cases: case_id, rings, discovery, burn_area_m2.
    """
    kept = once(in_first_chain(detections.join(cases.select("case_id", "discovery"), "case_id"), gap_days, "discovery").select("case_id", "sat_ts", "x", "y"))
    curve = coverage_curve(kept, burns=cases.select("case_id", "rings"))
    met = curve.join(cases.select("case_id", "burn_area_m2"), "case_id")
    return curve, times_to_fractions(met, kept, {"sat_end": fraction}, F.col("burn_area_m2"), reached=True)


#: Why a case has no times, in the order in which it is asked.
SKIPS = ("no burn polygon", "burn polygon empty", "no hotspots within the bounds", "no hotspots after ignition", "no hotspots inside the burn", "cover never reached the start fraction")


def dated(cases: DataFrame, hotspots: DataFrame, gap_days: float = config.CHAIN_GAP_DAYS, start_fraction: float = config.START_FRACTION, end_fraction: float = config.END_FRACTION, tile: float = 200.0) -> DataFrame:
    """cases (case_id, rings, discovery, fireout, ...) with their satellite times, status and reason, from all hotspots (sat_ts, x, y).

    Hotspots in the burn and not before discovery count. Cover of the first chain from a day before discovery gives SatelliteIgnitionTime; a chain that begins
    at that time gives SatelliteEnd_chain and, by the cover of its own detections, SatelliteEnd_coverage. SKIP: one of SKIPS, no times. PARTIAL: cover that never ends. ERROR: a
    discovery, given as text, that is no time. burn_area_m2 is taken from the rings where cases have none.
    """
    text = dict(cases.dtypes)["discovery"] == "string"
    begun = lenient_timestamp(F.col("discovery")) if text else F.col("discovery")
    area = F.col("burn_area_m2") if "burn_area_m2" in cases.columns else shoelace(edges_of(F.col("rings")))
    known = cases.select("case_id", "rings", begun.cast("timestamp_ntz").alias("__begun"), area.alias("__area"))
    after = F.col("sat_ts") >= F.col("__begun")
    inside = after & strictly_within(F.col("x").cast("double"), F.col("y").cast("double"), edges_of(F.col("rings")))
    burns = known.where("size(flatten(rings)) > 0")
    near = near_points(hotspots.select("sat_ts", "x", "y").where("sat_ts is not null"), burns, tile, "case_id")
    pairs = once(near.select("case_id", "sat_ts", "x", "y", "__begun", "__area", F.coalesce(after, F.lit(False)).alias("after"), F.coalesce(inside, F.lit(False)).alias("inside")))
    seen = pairs.where("inside").withColumn("__from", F.col("__begun") - F.expr("interval 1 day"))
    times = []
    for start, fraction, name in (("__from", start_fraction, "SatelliteIgnitionTime"), ("SatelliteIgnitionTime", end_fraction, "SatelliteEnd_coverage")):
        rows = once(in_first_chain(seen, gap_days, start).select("case_id", "sat_ts", "x", "y", "chain_end"))
        curve = coverage_curve(rows).join(known.select("case_id", "__area"), "case_id")
        ends = rows.groupBy("case_id").agg(F.max("chain_end").alias("SatelliteEnd_chain"))
        times.append(once(times_to_fractions(curve, rows, {name: fraction}, F.col("__area")).join(ends, "case_id").where(F.col(name).isNotNull() | F.lit(bool(times)))))
        seen = seen.join(times[0].select("case_id", "SatelliteIgnitionTime"), "case_id") if len(times) == 1 else seen
    counts = pairs.groupBy("case_id").agg(F.count_if("after").alias("n_after"), F.count_if("inside").alias("n_inside"))
    out = cases.join(known.select("case_id", "__begun"), "case_id").join(counts, "case_id", "left").join(times[0].select("case_id", "SatelliteIgnitionTime"), "case_id", "left").join(times[1], "case_id", "left")
    out = out.withColumn("SatelliteEndTime", F.col("SatelliteEnd_coverage")).withColumn("EventEndTime", event_end(F.col("SatelliteEndTime"), F.col("fireout")))
    asked = [F.col("rings").isNull(), F.size(F.flatten("rings")) == 0, F.col("n_after").isNull(), F.col("n_after") == 0, F.col("n_inside") == 0, F.col("SatelliteIgnitionTime").isNull()]
    why = F.coalesce(*[F.when(c, reason) for c, reason in zip(asked, SKIPS, strict=True)])
    error = F.when(F.col("discovery").isNotNull() & F.col("__begun").isNull(), "discovery is no time")
    part = F.when(F.col("SatelliteEndTime").isNull(), "no coverage end")
    status = F.when(error.isNotNull(), "ERROR").when(why.isNotNull(), "SKIP").when(part.isNotNull(), "PARTIAL").otherwise("OK")
    return out.withColumn("status", status).withColumn("reason", F.coalesce(error, why, part)).drop("__begun", "n_after", "n_inside")


def duration_gate(cases: DataFrame, least_hours: float = config.MIN_DURATION_HOURS) -> DataFrame:
    """cases with `keep` and `reject_reason`: both satellite times are there and least_hours or more apart."""
    start, end = F.col("SatelliteIgnitionTime"), F.col("SatelliteEndTime")
    missing = start.isNull() | end.isNull()
    short = seconds_between(start, end) < least_hours * 3600
    return cases.withColumn("keep", ~missing & ~short).withColumn("reject_reason", F.when(missing, "no satellite times").when(short, "too short"))
