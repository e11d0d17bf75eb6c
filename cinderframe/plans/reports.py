"""Queries on scores and the tables of the report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..folders import once
from ..operators import reports as R
from ..operators import scoring as S
from .fixtures import frame
from .registry import query

SCORES = """
with masks as (
  select case_id, 'a' as model, observed, coalesce(toa_a >= 1, false) as simulated, toa_a / 3600.0 as toa_hours from cells
  union all select case_id, 'b', observed, coalesce(toa_b >= 1, false), toa_b / 60.0 from cells
), counts as (
  select case_id, model, count(*) filter (observed and simulated) as tp, count(*) filter (not observed and simulated) as fp,
    count(*) filter (observed and not simulated) as fn, count(*) filter (not observed and not simulated) as tn from masks group by all
), chance as (select *, tp + fp + fn + tn as n, (1.0 * (tp + fp) * (tp + fn) + 1.0 * (fn + tn) * (fp + tn)) / (1.0 * (tp + fp + fn + tn) * (tp + fp + fn + tn)) as pe from counts
), scores as (
  select case_id, model, tp, fp, fn, tn, (tp + fn) * 900.0 as observed_m2, (tp + fp) * 900.0 as simulated_m2,
    case when tp + fp + fn = 0 then 0.0 else 1.0 * tp / (tp + fp + fn) end as jaccard, case when 2 * tp + fp + fn = 0 then 0.0 else 2.0 * tp / (2 * tp + fp + fn) end as sorensen,
    case when pe = 1 then 0.0 else (1.0 * (tp + tn) / n - pe) / (1 - pe) end as kappa, case when tp + fn = 0 then 0.0 else 1.0 * (tp + fp) / (tp + fn) end as ratio_of_areas, tp + fp as burn_px
  from chance)
"""


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def scores(spark: SparkSession, sf: str) -> DataFrame:
    return S.scores(frame(spark, sf, "cells"), config.models(spark))


@query("a2_scores", "cells", SCORES + "select case_id, model, tp, fp, fn, tn, round(observed_m2, 6) as observed_m2, round(simulated_m2, 6) as simulated_m2, round(jaccard, 6) as jaccard, round(sorensen, 6) as sorensen, round(kappa, 6) as kappa, round(ratio_of_areas, 6) as ratio_of_areas, burn_px from scores")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(scores(spark, sf), "observed_m2", "simulated_m2", "jaccard", "sorensen", "kappa", "ratio_of_areas")


@query("p21_hours", "cells", SCORES + "select case_id, model, round(max(toa_hours), 6) as last_hour from masks group by all")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(S.long_masks(frame(spark, sf, "cells"), config.models(spark)).groupBy("case_id", "model").agg(F.max("toa_hours").alias("last_hour")), "last_hour")


@query("p22_acres", "cells", SCORES + "select case_id, model, round(simulated_m2 * 0.000247105381, 6) as acres from scores")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return scores(spark, sf).select("case_id", "model", F.round(S.acres(F.col("simulated_m2")), 6).alias("acres"))


@query("p23_burned_cells", "cells", "select case_id, row_no, col_no, coalesce(toa_a >= 1, false) as burned from cells")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return frame(spark, sf, "cells").select("case_id", "row_no", "col_no", S.burned(F.col("toa_a")).alias("burned"))


@query("a6_histogram", "cells", """
with ends as (select case_id, min(toa_a) as vmin, max(toa_a) as vmax from cells where toa_a >= 1 group by case_id),
c as (select c.case_id, cast(least(floor((toa_a - vmin) / ((vmax - vmin) / 40)) + 1, 40) as bigint) as bin, count(*) as n from cells c join ends e on e.case_id = c.case_id where toa_a >= 1 group by all)
select e.case_id, b as bin, round(vmin + (b - 1) * ((vmax - vmin) / 40), 6) as lo, coalesce(n, 0) as n from ends e cross join generate_series(1, 40) g(b) left join c on c.case_id = e.case_id and c.bin = b
""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return R.histogram(frame(spark, sf, "cells").where("toa_a >= 1"), ["case_id"], "toa_a", 40).select("case_id", "bin", F.round("lo", 6).alias("lo"), "n")


@query("a6_growth_curve", "cells", """
with ends as (select case_id, min(toa_a) as vmin, max(toa_a) as vmax from cells where toa_a >= 1 group by case_id),
c as (select c.case_id, cast(least(floor((toa_a - vmin) / ((vmax - vmin) / 40)) + 1, 40) as bigint) as bin, count(*) as n from cells c join ends e on e.case_id = c.case_id where toa_a >= 1 group by all)
select e.case_id, b as bin, cast(sum(coalesce(n, 0)) over (partition by e.case_id order by b) * 900 as double) as area_m2 from ends e cross join generate_series(1, 40) g(b) left join c on c.case_id = e.case_id and c.bin = b
""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return R.growth_curve(frame(spark, sf, "cells"), ["case_id"], "toa_a", 40, config.CELL_M**2).select("case_id", "bin", "area_m2")


@query("a7_score_summary", "cells", SCORES + "select model, count(*) as n, round(avg(jaccard), 6) as mean_jaccard, round(median(jaccard), 6) as median_jaccard, round(avg(sorensen), 6) as mean_sorensen, round(median(sorensen), 6) as median_sorensen, round(avg(kappa), 6) as mean_kappa, round(median(kappa), 6) as median_kappa, round(median(ratio_of_areas), 6) as median_ratio from scores group by model")
def _(spark: SparkSession, sf: str) -> DataFrame:
    got = R.score_summary(scores(spark, sf))
    return rounded(got, *[c for c in got.columns if c not in ("model", "n")])


@query("a9_best_fit", "cells", SCORES + "select model, count(*) as n, round(regr_slope(jaccard, x), 6) as slope, round(regr_intercept(jaccard, x), 6) as intercept, round(regr_r2(jaccard, x), 6) as r2 from (select model, jaccard, log10(observed_m2 * 0.000247105381) as x from scores where observed_m2 > 0) s group by model")
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = scores(spark, sf).withColumn("acres", S.acres(F.col("observed_m2")))
    return rounded(R.best_fit(rows, ["model"], "acres", "jaccard", log_x=True), "slope", "intercept", "r2")


@query("a10_case_status", "cells", SCORES + "select c.case_id, case when max(jaccard) >= 0.01 then 'success' else 'non_ignited' end as status from (select case_id from cells union select 1000 + r_regionkey from region) c left join (select * from scores where case_id % 4 > 0 or model = 'z') s on s.case_id = c.case_id group by c.case_id")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """With cases of which no model has a score."""
    every = frame(spark, sf, "cells").select("case_id").union(spark.read.parquet(f"{sf}/region.parquet").select((1000 + F.col("r_regionkey")).cast("long"))).distinct()
    return R.case_status(scores(spark, sf).where("case_id % 4 > 0"), every)


@query("a10_status_totals", "cells", SCORES + """
, states as (select case_id, case when max(jaccard) >= 0.01 then 'success' else 'non_ignited' end as status from scores where case_id % 3 > 0 group by case_id),
every as (select distinct case_id from cells union select 1000 + r_regionkey from region)
select coalesce(status, 'total') as status, count(*) as n from (select coalesce(status, 'failed') as status from every left join states using (case_id)) s group by rollup (status)
""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """With cases that failed: a third of all, and some that have no cells."""
    every = frame(spark, sf, "cells").select("case_id").union(spark.read.parquet(f"{sf}/region.parquet").select((1000 + F.col("r_regionkey")).cast("long")))
    got = scores(spark, sf).where("case_id % 3 > 0")
    return R.status_counts(R.case_status(got, got.select("case_id").distinct()), every)


@query("a6_score_histogram", "cells", SCORES + """
, b as (select model, cast(least(25, greatest(5, count(*) // 3)) as bigint) as bins from scores group by model),
c as (select s.model, cast(least(floor(jaccard * bins) + 1, bins) as bigint) as bin, count(*) as n from scores s join b on b.model = s.model group by all)
select b.model, g.bin, bins, coalesce(n, 0) as n from b join (select unnest(generate_series(1, 25)) as bin) g on g.bin <= bins left join c on c.model = b.model and c.bin = g.bin
""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return R.score_histogram(scores(spark, sf))


BIAS = SCORES.rstrip() + ", bias as (select case_id, model, log2(ratio_of_areas) as log2_ratio, row_number() over (partition by model order by log2(ratio_of_areas), case_id) as nth from scores where ratio_of_areas > 0)\n"


@query("a12_area_bias", "cells", BIAS + "select case_id, model, round(log2_ratio, 6) as log2_ratio, nth from bias")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(R.area_bias(scores(spark, sf)), "log2_ratio")


@query("a12_bias_summary", "cells", BIAS + "select model, count(*) as n, round(100.0 * count(*) filter (log2_ratio > 0) / count(*), 6) as over_pct, round(median(log2_ratio), 6) as median, round(max(lower), 6) as lower, round(max(upper), 6) as upper from bias, (select least(-2.0, 1.2 * min(log2_ratio)) as lower, greatest(2.0, 1.2 * max(log2_ratio)) as upper from bias) l group by model")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(R.bias_summary(R.area_bias(scores(spark, sf))), "over_pct", "median", "lower", "upper")


@query("a18_feature_matrix", "cells weather_hourly", SCORES + """
select s.case_id, s.model, metric, round(v, 6) as value, round(w.wind, 4) as wind_kph, round(s.simulated_m2 * 0.000247105381, 4) as acres, round(h.hours, 4) as hours
from (select *, unnest(['jaccard', 'sorensen', 'kappa']) as metric, unnest([jaccard, sorensen, kappa]) as v from scores) s
left join (select case_id, avg(wind_kph) as wind from weather_hourly group by case_id) w on w.case_id = s.case_id
left join (select case_id, model, max(toa_hours) as hours from masks group by all) h on h.case_id = s.case_id and h.model = s.model
""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    hours = S.long_masks(frame(spark, sf, "cells"), config.models(spark)).groupBy("case_id", "model").agg(F.max("toa_hours").alias("hours"))
    wide = R.features(scores(spark, sf), hours, frame(spark, sf, "weather_hourly"))
    wide = wide.withColumns({k: F.round(k, 4) for k in ("wind_kph", "acres", "hours")})
    return rounded(R.unpivoted(wide, ["case_id", "model", "wind_kph", "acres", "hours"], ["jaccard", "sorensen", "kappa"]), "value")


@query("a19_availability", "cells hotspots", SCORES + "select c.case_id, coalesce(string_agg(c.model, ',' order by c.model) filter (s.model is not null), '') as found, coalesce(string_agg(c.model, ',' order by c.model) filter (s.model is null), '') as missing, coalesce(max(h.points), 0) as points from (select distinct case_id, m as model from cells, (values ('a'), ('b'), ('c')) t(m)) c left join scores s on s.case_id = c.case_id and s.model = c.model left join (select case_id, count(*) as points from hotspots where case_id % 3 > 0 group by case_id) h on h.case_id = c.case_id group by c.case_id")
def _(spark: SparkSession, sf: str) -> DataFrame:
    expected = frame(spark, sf, "cells").select("case_id").distinct().withColumn("model", F.explode(F.array(*map(F.lit, "abc"))))
    return R.availability(scores(spark, sf), expected, frame(spark, sf, "hotspots").where("case_id % 3 > 0"))


@query("p37_metrics_panel", "cells", SCORES + "select case_id, model, unnest(['tp', 'fp', 'fn', 'tn', 'jaccard', 'ratio_of_areas']) as metric, round(unnest([cast(tp as double), fp, fn, tn, jaccard, ratio_of_areas]), 6) as value from scores")
def _(spark: SparkSession, sf: str) -> DataFrame:
    wide = scores(spark, sf).withColumns({k: F.col(k).cast("double") for k in ("tp", "fp", "fn", "tn")})
    return rounded(R.unpivoted(wide, ["case_id", "model"], ["tp", "fp", "fn", "tn", "jaccard", "ratio_of_areas"]), "value")


@query("t1_top_and_bottom", "cells", SCORES + """
, fit as (select case_id, model, case when case_id % 10 = 7 and model = 'b' then null when case_id % 10 = 2 then jaccard * 0.001 else jaccard end as jaccard from scores),
good as (select * from fit where jaccard is not null and case_id in (select case_id from fit group by case_id having max(jaccard) >= 0.01))
select model, 'top' as place, row_number() over (partition by model order by jaccard desc, case_id) as nth, case_id, round(jaccard, 6) as score from good qualify nth <= 3
union all select model, 'bottom', row_number() over (partition by model order by jaccard, case_id) as nth, case_id, round(jaccard, 6) from good qualify nth <= 3
""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """With an infinite score and a case that no model fits."""
    case, model = F.col("case_id") % 10, F.col("model")
    infinite = F.when((case == 7) & (model == "b"), F.lit(float("inf"))).when(case == 2, F.col("jaccard") * 0.001).otherwise(F.col("jaccard"))
    got = once(scores(spark, sf).withColumn("jaccard", infinite))
    status = R.case_status(got.where("jaccard < double('infinity')"), got.select("case_id").distinct())
    return rounded(R.top_and_bottom(got, 3, status=status), "score")


@query("t4_bias_bars", "cells", BIAS + "select model, nth, substr('case number ' || case_id || ' of the evaluation', 1, 24) as label, round(log2_ratio, 6) as log2_ratio from bias")
def _(spark: SparkSession, sf: str) -> DataFrame:
    label = F.substring(F.concat(F.lit("case number "), F.col("case_id").cast("string"), F.lit(" of the evaluation")), 1, 24)
    return rounded(R.area_bias(scores(spark, sf)).select("model", "nth", label.alias("label"), "log2_ratio"), "log2_ratio")


@query("u4_results_of_all_cases", "cells weather_hourly", SCORES + "select c.case_id, s.model, round(s.jaccard, 6) as jaccard, case when s.case_id is null then 'no result' end as error from (select distinct case_id + 3 as case_id from weather_hourly) c left join scores s on s.case_id = c.case_id")
def _(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators.cases import all_results

    wanted = frame(spark, sf, "weather_hourly").select((F.col("case_id") + 3).alias("case_id")).distinct()
    return rounded(all_results(wanted, scores(spark, sf).select("case_id", "model", "jaccard")), "jaccard")
