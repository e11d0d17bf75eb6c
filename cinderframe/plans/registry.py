"""All queries of the fire evaluation, each with its SQL twin where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .fixtures import with_fixtures

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


#: Columns of SQL twins that DuckDB would give another type than Spark does.
_CASTS = {
    "p17_grown_bounds": "xmin double, ymin double, xmax double, ymax double", "j18_polygon_mask": "row_no integer, first_col integer", "j12_nearest_grid": "row_no integer, col_no integer",
    "j13_bilinear_grid": "row_no integer, col_no integer", "j13_coarse_wind": "row_no integer, col_no integer", "w11_fit_to_reference": "row_no integer, col_no integer", "w10_band_numbers": "band integer", "p20_class_width": "width double",
    "a15_barrier_on_grid": "width double", "a2_scores": "observed_m2 double, simulated_m2 double", "p22_acres": "acres double", "t1_top_and_bottom": "nth integer",
    "t3_status_order": "place integer", "t5_first_lines": "line_no integer", "s12_grid_text": "line_no integer",
    "s11_grid_from_text": "x double, y double", "s11_grid_files": "x double, y double", "s11_grid_header": "ncols bigint, nrows bigint", "t2_sorted_summary": "place integer", "w8_after_conditioning": "nth integer",
    "s10_weather_text": "line_no integer", "u1_stacked_grids": "band integer",
}


def _typed(name: str, sql: str) -> str:
    if name not in _CASTS:
        return sql
    casts = ", ".join(f"cast({c} as {t}) as {c}" for c, t in (x.split() for x in _CASTS[name].split(", ")))
    return f"select * replace ({casts}) from ({sql}) typed"


def query(name: str, fixtures: str = "", sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under a name; sql reads the named fixtures and the driver's tables."""

    def keep(f: Query) -> Query:
        _QUERIES[name] = f
        if sql is not None:
            _SQL[name] = _typed(name, with_fixtures(fixtures.split(), sql) if fixtures else sql.strip())
        return f

    return keep


def queries() -> dict[str, Query]:
    from . import burns, dating, grids, reports, runs, streams, weather  # noqa: F401  they register themselves

    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(_SQL)
