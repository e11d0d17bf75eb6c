"""Simulated against observed burn: masks, confusion counts and scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from .reports import safe_divide


def burned(toa: Column, threshold: float = config.TOA_THRESHOLD, nodata: float = config.NODATA) -> Column:
    """Whether an arrival time is one: there, a number, not nodata, and at or above the threshold. Never null."""
    return F.coalesce(toa.isNotNull() & ~F.isnan(toa.cast("double")) & (toa != nodata) & (toa >= threshold), F.lit(False))


def to_hours(unit: Column) -> Column:
    """Hours of one unit of time; seconds if the unit is unknown."""
    known = F.create_map(*[F.lit(x) for pair in config.HOURS_PER_UNIT.items() for x in pair])
    return F.coalesce(F.element_at(known, F.lower(unit)), F.lit(1 / 3600))


def acres(m2: Column) -> Column:
    return m2 * config.ACRES_PER_M2


def long_masks(cells: DataFrame, models: DataFrame) -> DataFrame:
    """(case_id, model, observed, simulated, toa_hours): a row for each cell and model. `models` has a row per model: model, toa_column, unit."""
    rows = models.collect()  # a setting of a few rows
    per = F.explode(F.array(*[F.struct(F.lit(r.model).alias("model"), F.lit(r.unit).alias("unit"), F.col(r.toa_column).cast("double").alias("toa")) for r in rows])).alias("m")
    wide = cells.select("case_id", F.coalesce("observed", F.lit(False)).alias("observed"), per)
    return wide.select("case_id", "m.model", "observed", burned(F.col("m.toa")).alias("simulated"), (F.col("m.toa") * to_hours(F.col("m.unit"))).alias("toa_hours"))


def confusion(masks: DataFrame, by: list[str] | None = None) -> DataFrame:
    """tp, fp, fn, tn of each group; summed in each task before the shuffle."""
    o, s = F.col("observed"), F.col("simulated")
    return masks.groupBy(*(by or ["case_id", "model"])).agg(F.count_if(o & s).alias("tp"), F.count_if(~o & s).alias("fp"), F.count_if(o & ~s).alias("fn"), F.count_if(~o & ~s).alias("tn"))


def with_scores(counts: DataFrame, cell_area: float = config.CELL_M**2) -> DataFrame:
    """Counts with areas and scores; a score whose denominator is 0 is 0."""
    tp, fp, fn, tn = (F.col(k).cast("double") for k in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    by_chance = safe_divide((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn), n * n)
    agreed = safe_divide(tp + tn, n)
    return counts.withColumns({
        "observed_m2": (tp + fn) * cell_area, "simulated_m2": (tp + fp) * cell_area, "jaccard": safe_divide(tp, tp + fp + fn), "sorensen": safe_divide(2 * tp, 2 * tp + fp + fn),
        "kappa": safe_divide(agreed - by_chance, 1 - by_chance), "ratio_of_areas": safe_divide(tp + fp, tp + fn), "burn_px": F.col("tp") + F.col("fp"),
    })


def scores(cells: DataFrame, models: DataFrame, cell_area: float = config.CELL_M**2) -> DataFrame:
    return with_scores(confusion(long_masks(cells, models)), cell_area)
