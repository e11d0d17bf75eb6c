"""Tables of the engine: names, types and the check that a source has what it must."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_TYPES = {"long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType(), "ntz": T.TimestampNTZType(), "boolean": T.BooleanType()}


def struct(fields: str) -> T.StructType:
    """A schema from `name type` pairs separated by commas; `ntz` is a timestamp without time zone."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in (f.split() for f in fields.split(","))])


PERIMETERS = struct("perim_idx long, perim_name string, ig_date ntz, acres double")
IGNITIONS = struct("pt_idx long, point_name string, discovery ntz, fireout ntz, x double, y double")
HOTSPOTS = struct("det_id long, acq_date string, acq_time string, x double, y double")
CASES = struct("folder string, perim_idx long, perim_name string, perim_ignition ntz, perim_area_acres double, point_name string, point_discovery ntz, point_fireout ntz")
SATELLITE_TIMES = ("SatelliteIgnitionTime", "SatelliteEnd_chain", "SatelliteEnd_coverage", "SatelliteEndTime", "EventEndTime")
WEATHER = struct("case_id long, ts ntz, temp_c double, rh double, pcp_mm double, wind_kph double, wind_dir_deg double, cloud_pct double")
CELLS = struct("case_id long, layer string, band int, row_no int, col_no int, value double")
RUN_LOG = struct("case_id long, line_no long, ts ntz, text string")


def require_columns(df: DataFrame, *columns: str) -> DataFrame:
    """df, or an error that names the columns it lacks and those it has."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; there are {df.columns}")
    return df
