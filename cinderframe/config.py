"""Settings of the evaluation, and the small tables that stand in for code: a further model, class or product is a further row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Limits and units of the evaluation.
MIN_ACRES = 5000.0
MATCH_DAYS = 2
CHAIN_GAP_DAYS = 7
DISC_RADIUS_M, COVER_CELL_M = 200.0, 50.0
START_FRACTION, END_FRACTION = 0.05, 0.9
MIN_DURATION_HOURS = 12
CONDITIONING_DAYS = 20
CONDITIONING_HOURS = 24 * CONDITIONING_DAYS
TOA_THRESHOLD = 1.0
CELL_M = 30.0
ACRES_PER_M2 = 0.000247105381
SUCCESS_JACCARD = 0.01
NODATA = -9999.0
FIRST_FUEL = 101
MAX_SNAP_RADIUS = 2000
WINDOW_DAYS = 13
BBOX_FACTOR = 1.5

# Hours in a time unit; anything else is seconds.
HOURS_PER_UNIT = {"s": 1 / 3600, "sec": 1 / 3600, "min": 1 / 60, "h": 1.0, "hr": 1.0}
# Layers of a landscape file by band.
BAND_LAYERS = {1: "dem", 2: "slp", 3: "asp", 4: "fbfm40", 5: "cc", 6: "ch", 7: "cbh", 8: "cbd"}
# Widths in metres of barrier classes, in drawing order: in one layer a later class replaces an earlier one.
ROAD_WIDTHS = {"motorway": 30.0, "trunk": 25.0, "primary": 16.0, "secondary": 12.0, "tertiary": 10.0, "residential": 8.0, "service": 6.0, "track": 4.0, "path": 2.0}
WATER_WIDTHS = {"river": 30.0, "stream": 6.0, "canal": 10.0, "ditch": 3.0, "drain": 2.0}
CLASS_WIDTHS = [("road", k, w) for k, w in ROAD_WIDTHS.items()] + [("water", k, w) for k, w in WATER_WIDTHS.items()]
BACKUP_WIDTH_M, BACKUP_TOLERANCE_M = 5.0, 1.0
# Years of fuel products.
PRODUCT_YEARS = (2016, 2022, 2023, 2024)
# States of a run, in the order of the overview.
STATUS_ORDER = ("running", "starting", "failed", "done", "pending")


def models(spark: SparkSession) -> DataFrame:
    """The simulators: name, arrival-time column and its unit."""
    return spark.createDataFrame([("a", "toa_a", "s"), ("b", "toa_b", "min")], "model string, toa_column string, unit string")


def class_widths(spark: SparkSession, widths: list[tuple[str, str, float]] | None = None) -> DataFrame:
    """(layer, class, width, class_rank): rank follows the drawing order."""
    rows = [(layer, kind, width, i) for i, (layer, kind, width) in enumerate(widths or CLASS_WIDTHS)]
    return spark.createDataFrame(rows, "layer string, class string, width double, class_rank int")


def band_layers(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(BAND_LAYERS.items()), "band int, layer string")
