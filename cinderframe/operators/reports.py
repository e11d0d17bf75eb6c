"""The tables behind the report: rollups, curves, fits, histograms, rankings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from ..folders import medians, numbered_within, once


def safe_divide(n: Column, d: Column) -> Column:
    return F.when(d == 0, F.lit(0.0)).otherwise(n / d)


def status_totals(df: DataFrame, column: str = "status") -> DataFrame:
    """(status, n) for each status, and for all as `total`."""
    return df.rollup(column).agg(F.count("*").alias("n")).select(F.coalesce(F.col(column), F.lit("total")).alias("status"), "n")


def normalised(value: str, by: str) -> Column:
    """A curve over its largest value; unchanged if that is not above 0."""
    top = F.max(value).over(Window.partitionBy(by))
    return F.when(top > 0, F.col(value) / top).otherwise(F.col(value))


def decimated(curve: DataFrame, by: str, order: str, most: int = 300) -> DataFrame:
    """At most `most` points of each curve, evenly spread by rank (halves go to even ranks), ends included."""
    ranked = Window.partitionBy(by).orderBy(order)
    rows = curve.withColumn("__i", F.row_number().over(ranked) - 1).withColumn("__n", F.count("*").over(Window.partitionBy(by)))
    # Rank i is chosen if some k of 0..most-1 rounds to it; only its nearest two can.
    step = (F.col("__n") - 1) / F.lit(most - 1)
    k = F.floor(F.col("__i") / step)
    chosen = (F.bround(k * step) == F.col("__i")) | (F.bround((k + 1) * step) == F.col("__i"))
    return rows.where((F.col("__n") <= most) | chosen).drop("__i", "__n")


def histogram(df: DataFrame, by: list[str], value: str, bins: int) -> DataFrame:
    """(by, bin 1..bins, lo, hi, n) on [min, max] of each group, the last bin closed, empty bins kept."""
    ends = df.groupBy(*by).agg(F.min(value).alias("vmin"), F.max(value).alias("vmax"))
    width = (F.col("vmax") - F.col("vmin")) / bins
    at = F.when(width == 0, F.lit(1)).otherwise(F.least(F.floor((F.col(value) - F.col("vmin")) / width) + 1, F.lit(bins)))
    counts = df.where(F.col(value).isNotNull()).join(ends, by).withColumn("bin", at.cast("long")).groupBy(*by, "bin").agg(F.count("*").alias("n"))
    every = ends.where("vmin is not null").withColumn("bin", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(bins).cast("long"))))
    joined = every.join(counts, [*by, "bin"], "left")
    return joined.select(*by, "bin", (F.col("vmin") + (F.col("bin") - 1) * width).alias("lo"), (F.col("vmin") + F.col("bin") * width).alias("hi"), F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def score_histogram(scores: DataFrame, score: str = "jaccard") -> DataFrame:
    """(model, bin, bins, n) of finite scores on [0, 1]: a third as many bins as scores, 5 to 25, empty ones kept, the last one closed."""
    finite = scores.where(F.col(score).isNotNull() & ~F.isnan(score) & F.col(score).between(0, 1))
    bins = finite.groupBy("model").agg(F.least(F.lit(25), F.greatest(F.lit(5), F.floor(F.count("*") / 3))).cast("long").alias("bins"))
    at = F.least(F.floor(F.col(score) * F.col("bins")) + 1, F.col("bins"))
    counts = finite.join(bins, "model").groupBy("model", at.alias("bin")).agg(F.count("*").alias("n"))
    every = bins.withColumn("bin", F.explode(F.sequence(F.lit(1).cast("long"), F.col("bins"))))
    return every.join(counts, ["model", "bin"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def growth_curve(cells: DataFrame, by: list[str], toa: str, bins: int, cell_area: float, threshold: float = config.TOA_THRESHOLD) -> DataFrame:
    """(by, t, area_m2): burned area by arrival time, from a histogram in place of a sort."""
    counts = histogram(cells.where(F.col(toa) >= threshold), by, toa, bins)
    upto = Window.partitionBy(*by).orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counts.select(*by, "bin", F.col("hi").alias("t"), (F.sum("n").over(upto) * cell_area).alias("area_m2"))


def best_fit(df: DataFrame, by: list[str], x: str, y: str, log_x: bool = False, least: int = 3) -> DataFrame:
    """(by, n, slope, intercept, r2) of a straight line through finite pairs; nulls with fewer than `least`."""
    xs = F.when(F.col(x) > 0, F.log10(x)) if log_x else F.col(x).cast("double")
    pairs = df.withColumn("__x", xs).withColumn("__y", F.col(y).cast("double")).where("__x is not null and __y is not null and not isnan(__x) and not isnan(__y) and abs(__x) < double('infinity') and abs(__y) < double('infinity')")
    enough = F.count("*") >= least
    return pairs.groupBy(*by).agg(F.count("*").alias("n"), *[F.when(enough, f("__y", "__x")).alias(k) for k, f in (("slope", F.regr_slope), ("intercept", F.regr_intercept), ("r2", F.regr_r2))])


def score_summary(scores: DataFrame) -> DataFrame:
    """(model, n, mean and median of the three scores, median area ratio)."""
    kept = once(scores.select("model", "jaccard", "sorensen", "kappa", "ratio_of_areas"))
    means = kept.groupBy("model").agg(F.count("*").alias("n"), *[F.avg(k).alias(f"mean_{k}") for k in ("jaccard", "sorensen", "kappa")])
    middle = medians(kept, ["model"], ["jaccard", "sorensen", "kappa", "ratio_of_areas"])
    of = lambda k, name: F.max(F.when(F.col("column") == k, F.col("median"))).alias(name)
    wide = middle.groupBy("model").agg(of("jaccard", "median_jaccard"), of("sorensen", "median_sorensen"), of("kappa", "median_kappa"), of("ratio_of_areas", "median_ratio"))
    return means.join(wide, "model", "left").select("model", "n", "mean_jaccard", "median_jaccard", "mean_sorensen", "median_sorensen", "mean_kappa", "median_kappa", "median_ratio")


def area_bias(scores: DataFrame) -> DataFrame:
    """(case_id, model, log2_ratio, nth) of finite positive area ratios, ascending in each model, ties by case."""
    ratio = F.col("ratio_of_areas")
    rows = scores.where((ratio > 0) & ~F.isnan(ratio) & (ratio < float("inf"))).select("case_id", "model", F.log2(ratio).alias("log2_ratio"))
    return numbered_within(rows, ["model"], "log2_ratio", "case_id")


def bias_summary(bias: DataFrame) -> DataFrame:
    """(model, n, over_pct, median, lower, upper) of numbered rows, as area_bias() gives them; the limits are those of all models together."""
    sizes = bias.groupBy("model").agg(F.count("*").alias("n"), (100.0 * F.count_if(F.col("log2_ratio") > 0) / F.count("*")).alias("over_pct"))
    middle = bias.join(sizes.select("model", "n"), "model").where((F.col("nth") * 2).between(F.col("n"), F.col("n") + 2)).groupBy("model").agg(F.avg("log2_ratio").alias("median"))
    limits = bias.agg(F.least(F.lit(-2.0), 1.2 * F.min("log2_ratio")).alias("lower"), F.greatest(F.lit(2.0), 1.2 * F.max("log2_ratio")).alias("upper"))
    return sizes.join(middle, "model").join(F.broadcast(limits)).select("model", "n", "over_pct", "median", "lower", "upper")  # one row


def top_and_bottom(scores: DataFrame, n: int = 10, by: str = "jaccard", status: DataFrame | None = None) -> DataFrame:
    """(model, place, nth, case_id, score): the n best and n worst finite scores of each model, ties by case; only of cases that `status` (case_id, status) calls a success."""
    finite = scores.where(F.col(by).isNotNull() & ~F.isnan(by) & (F.abs(by) < float("inf")))
    if status is not None:
        finite = finite.join(status.where("status = 'success'").select("case_id"), "case_id", "left_semi")
    out = []
    for place, order in (("top", F.desc(by)), ("bottom", F.asc(by))):
        ranked = finite.withColumn("nth", F.row_number().over(Window.partitionBy("model").orderBy(order, "case_id")))
        out.append(ranked.where(F.col("nth") <= n).select("model", F.lit(place).alias("place"), "nth", "case_id", F.col(by).alias("score")))
    return out[0].unionByName(out[1])


def case_status(scores: DataFrame, cases: DataFrame) -> DataFrame:
    """(case_id, status): success if a model's Jaccard reaches the least success, else non_ignited, also if no model has a score."""
    best = scores.groupBy("case_id").agg(F.max("jaccard").alias("best"))
    return cases.select("case_id").join(best, "case_id", "left").select("case_id", F.when(F.col("best") >= config.SUCCESS_JACCARD, "success").otherwise("non_ignited").alias("status"))


def status_counts(statuses: DataFrame, cases: DataFrame) -> DataFrame:
    """(status, n): cases by status, failed those of `cases` that have none, and a total."""
    known = cases.select("case_id").distinct().join(statuses, "case_id", "left").select(F.coalesce("status", F.lit("failed")).alias("status"))
    return status_totals(known)


def features(scores: DataFrame, hours: DataFrame, weather: DataFrame) -> DataFrame:
    """(case_id, model, acres, hours, wind_kph, jaccard, sorensen, kappa): simulated acres, last arrival (case_id, model, hours) and mean wind beside the scores."""
    wind = weather.groupBy("case_id").agg(F.avg("wind_kph").alias("wind_kph"))
    acres = (F.col("simulated_m2") * config.ACRES_PER_M2).alias("acres")
    return scores.join(hours, ["case_id", "model"], "left").join(wind, "case_id", "left").select("case_id", "model", acres, "hours", "wind_kph", "jaccard", "sorensen", "kappa")


def unpivoted(df: DataFrame, ids: list[str], values: list[str], name: str = "metric", value: str = "value") -> DataFrame:
    return df.unpivot(ids, values, name, value)


def availability(results: DataFrame, expected: DataFrame, points: DataFrame | None = None) -> DataFrame:
    """(case_id, found, missing[, points]): labels of models with and without a result, sorted, and the number of a case's rows in `points`."""
    known = expected.join(results.select("case_id", "model", F.lit(True).alias("there")), ["case_id", "model"], "left")
    some = lambda c: F.concat_ws(",", F.array_sort(F.collect_list(F.when(c, F.col("model")))))
    out = known.groupBy("case_id").agg(some(F.col("there").isNotNull()).alias("found"), some(F.col("there").isNull()).alias("missing"))
    if points is None:
        return out
    return out.join(points.groupBy("case_id").agg(F.count("*").alias("points")), "case_id", "left").withColumn("points", F.coalesce("points", F.lit(0)))
