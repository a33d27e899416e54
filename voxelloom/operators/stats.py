"""Distribution statistics: exact percentiles, histograms, thresholds and matching."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def trimmed(df: DataFrame, value: str, keys: list[str], k: float = 3.0) -> DataFrame:
    """Rows within k population deviations of their group's median. Two grouped passes, no window over a group."""
    centre = df.groupBy(*keys).agg(F.percentile(value, F.lit(0.5)).alias("_m"), F.stddev_pop(value).alias("_s"))
    kept = df.join(centre, keys) if keys else df.crossJoin(centre)  # one row where there is no key
    return kept.filter(F.abs(F.col(value) - F.col("_m")) <= k * F.col("_s")).drop("_m", "_s")


def offset_summary(df: DataFrame, value: str, keys: list[str], k: float = 3.0) -> DataFrame:
    """Median, minimum and maximum after the trim."""
    return trimmed(df, value, keys, k).groupBy(*keys).agg(F.percentile(value, F.lit(0.5)).alias("median"), F.min(value).alias("low"), F.max(value).alias("high"))


def histogram(df: DataFrame, value: str, keys: list[str] | None = None) -> DataFrame:
    """(keys, value, n) and the cumulative share cdf of each distinct value. The windows run over distinct values."""
    keys = keys or []
    h = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*keys).orderBy(value)
    return h.withColumn("below", F.sum("n").over(w)).withColumn("cdf", F.col("below") / F.sum("n").over(Window.partitionBy(*keys)))


def match_histogram(source: DataFrame, target: DataFrame, value: str) -> DataFrame:
    """(value, n, matched): each distinct source value mapped to the target value of its quantile, by linear
    interpolation between the target's quantiles, constant outside them. Union and windows instead of a range join."""
    s, t = histogram(source, value), histogram(target, value)
    both = s.select(F.col("cdf").alias("q"), F.lit(1).alias("is_source"), F.col(value).alias("sv"), "n", F.lit(None).cast("double").alias("tv")).unionByName(
        t.select(F.col("cdf").alias("q"), F.lit(0).alias("is_source"), F.lit(None).cast(source.schema[value].dataType).alias("sv"), F.lit(None).cast("long").alias("n"), F.col(value).cast("double").alias("tv"))
    )
    mark = F.when(F.col("is_source") == 0, F.struct("q", "tv"))
    before = Window.orderBy("q", "is_source").rowsBetween(Window.unboundedPreceding, 0)
    after = Window.orderBy("q", F.desc("is_source")).rowsBetween(0, Window.unboundedFollowing)
    w = both.withColumn("lo", F.last(mark, ignorenulls=True).over(before)).withColumn("hi", F.first(mark, ignorenulls=True).over(after)).filter("is_source = 1")
    lo, hi = F.col("lo"), F.col("hi")
    between = F.when(lo["q"] == hi["q"], lo["tv"]).otherwise(lo["tv"] + (F.col("q") - lo["q"]) * (hi["tv"] - lo["tv"]) / (hi["q"] - lo["q"]))
    return w.select(F.col("sv").alias(value), "n", F.when(lo.isNull(), hi["tv"]).when(hi.isNull(), lo["tv"]).otherwise(between).alias("matched"))


def otsu(hist: DataFrame, value: str, keys: list[str] | None = None) -> DataFrame:
    """The threshold of each group's histogram (value, n) with the greatest variance between classes; the lowest of ties.
    A group with one value gets that value."""
    keys = keys or []
    up, whole = Window.partitionBy(*keys).orderBy(value), Window.partitionBy(*keys)
    h = hist.withColumn("w0", F.sum("n").over(up)).withColumn("s0", F.sum(F.col("n") * F.col(value)).over(up)).withColumn("w", F.sum("n").over(whole)).withColumn("s", F.sum(F.col("n") * F.col(value)).over(whole))
    w1 = F.col("w") - F.col("w0")
    gap = F.col("s0") / F.col("w0") - (F.col("s") - F.col("s0")) / F.when(w1 > 0, w1)
    var = F.coalesce(F.col("w0") * w1 * gap * gap, F.lit(-1.0))
    return h.groupBy(*keys).agg(F.min_by(value, F.struct(-var, F.col(value))).alias("threshold"))


def multi_otsu(hist: DataFrame, value: str, bins: int = 64) -> DataFrame:
    """Three thresholds (t1 < t2 < t3) of four classes on a histogram of at most `bins` equal bins: places are the
    bins' centres. The search joins cumulative sums of at most `bins` rows."""
    ends = hist.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    b = hist.crossJoin(ends).withColumn("b", F.when(F.col("hi") > F.col("lo"), F.least(F.lit(bins - 1), F.floor((F.col(value) - F.col("lo")) * bins / (F.col("hi") - F.col("lo")))).cast("int")).otherwise(0))
    h = b.groupBy("b").agg(F.sum("n").cast("double").alias("n"), F.first("lo").alias("lo"), F.first("hi").alias("hi"))
    c = h.withColumn("w", F.sum("n").over(Window.orderBy("b"))).withColumn("m", F.sum(F.col("n") * F.col("b")).over(Window.orderBy("b")))
    whole = h.agg(F.sum("n").alias("W"), F.sum(F.col("n") * F.col("b")).alias("M"))
    cut = [c.select(F.col("b").alias(f"b{k}"), F.col("w").alias(f"w{k}"), F.col("m").alias(f"m{k}"), *(["lo", "hi"] if k == 1 else [])) for k in (1, 2, 3)]
    t = cut[0].join(cut[1], F.col("b1") < F.col("b2")).join(cut[2], F.col("b2") < F.col("b3")).crossJoin(whole)
    part = lambda dm, dw: F.when(dw > 0, dm * dm / dw).otherwise(0)
    score = part(F.col("m1"), F.col("w1")) + part(F.col("m2") - F.col("m1"), F.col("w2") - F.col("w1")) + part(F.col("m3") - F.col("m2"), F.col("w3") - F.col("w2")) + part(F.col("M") - F.col("m3"), F.col("W") - F.col("w3"))
    best = t.withColumn("score", score).orderBy(F.desc("score"), "b1", "b2", "b3").limit(1)
    centre = lambda k: F.col("lo") + (F.col(f"b{k}") + 0.5) * (F.col("hi") - F.col("lo")) / bins
    return best.select(*(centre(k).alias(f"t{k}") for k in (1, 2, 3)))


def bit_shift(bound: Column) -> Column:
    """The least b in 0..8 with 256 * 2^b >= bound, else 8."""
    return F.least(F.lit(8), F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(bound, F.lit(1.0)) / 256)))).cast("int")


def estimate_bit_shift(df: DataFrame, value: str, threshold: float, percent: float, keys: list[str]) -> DataFrame:
    """Shift for each group: the percentile of log values above a threshold (their maximum if none is), back from the log."""
    log = F.log1p(value)
    above = F.percentile(F.when(log > threshold, log), F.lit(percent / 100))
    bound = F.rint(F.expm1(F.coalesce(above, F.max(log))))
    return df.groupBy(*keys).agg(bound.cast("long").alias("bound"), bit_shift(bound).alias("shift"))


def local_percentile(px: DataFrame, percent: float, half_y: int, half_x: int, spacing: int, keys: list[str]) -> DataFrame:
    """The percentile of the rectangle around each place of a grid. Each pixel goes to the few places that cover it."""
    reach = lambda c, half: F.sequence(F.ceil((F.col(c) - half) / spacing).cast("int"), F.floor((F.col(c) + half) / spacing).cast("int"))
    each = px.filter(F.col("y").isNotNull()).withColumn("gy", F.explode(F.when(F.ceil((F.col("y") - half_y) / spacing) <= F.floor((F.col("y") + half_y) / spacing), reach("y", half_y))))
    each = each.withColumn("gx", F.explode(F.when(F.ceil((F.col("x") - half_x) / spacing) <= F.floor((F.col("x") + half_x) / spacing), reach("x", half_x)))).filter("gy >= 0 and gx >= 0")
    return each.groupBy(*keys, "gy", "gx").agg(F.percentile("v", F.lit(percent)).alias("v"))


def uniform(px: DataFrame, keys: list[str]) -> DataFrame:
    """Whether all pixels of a plane are equal; such planes skip every kernel."""
    return px.groupBy(*keys).agg((F.min("v") == F.max("v")).alias("uniform"), F.min("v").alias("low"), F.max("v").alias("high"))


def relative_change(df: DataFrame, before: str, after: str, keys: list[str]) -> DataFrame:
    """L2 norm and the percentage by which it changed."""
    norm = lambda c: F.sqrt(F.sum(F.col(c).cast("double") * F.col(c)))
    return df.groupBy(*keys).agg(norm(after).alias("norm"), (F.abs(norm(after) - norm(before)) / norm(before) * 100).alias("change"))
