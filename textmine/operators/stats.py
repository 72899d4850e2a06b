"""Statistics and plot-data tables: correlation test, log-log fits,
histograms, five-number summaries, linear trends and local regression.

All are grouped aggregates (``corr``, ``regr_*``, counts) or built on the
distributed row numbering, so no group is collected into one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmine.operators.verbs import as_list, measured, null_safe_join, row_number_by, running_sum
from textmine.sources.corpus import materialize

# 97.5% quantile of the standard normal distribution (95% two-sided CI).
Z_975 = 1.959963984540054


def cor_test(df: DataFrame, x: str, y: str, by: str | Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation test on complete pairs per group: ``estimate``,
    ``n``, ``statistic`` (t), ``parameter`` (df) and the 95% confidence
    interval (Fisher z)."""
    keys = as_list(by)
    pairs = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    agg = pairs.groupBy(*keys).agg(F.corr(x, y).alias("estimate"), F.count(F.lit(1)).alias("n"))
    r, n = F.col("estimate"), F.col("n")
    z, se = F.atanh(r), F.lit(1.0) / F.sqrt(n - 3)
    return agg.select(
        *keys, "estimate", "n",
        (r * F.sqrt((n - 2) / (F.lit(1.0) - r * r))).alias("statistic"),
        (n - 2).alias("parameter"),
        F.tanh(z - Z_975 * se).alias("conf_low"),
        F.tanh(z + Z_975 * se).alias("conf_high"),
    )


def t_two_sided_p(t: F.Column, dof: F.Column) -> F.Column:
    """Two-sided p-value of Student's t with ``dof`` degrees of freedom.

    With ``t = sqrt(dof) * tan(angle)`` the density becomes a power of the
    cosine, so the tail is the share of a smooth integral over angles, taken
    by Gauss-Legendre sums over the stretch that holds its mass, whatever the
    degrees of freedom.  Built-in expressions only.  Null where ``t`` is null
    or there are no degrees of freedom, NaN where it is NaN, 0 at infinity.
    """
    n, half_pi = dof.cast("double"), F.lit(math.pi / 2)
    nodes = F.array(*[F.struct(F.lit(float(a)).alias("a"), F.lit(float(w)).alias("w"))
                      for a, w in zip(*np.polynomial.legendre.leggauss(100))])

    def integral(start: F.Column) -> F.Column:
        end = F.least(half_pi, start + 16 / F.sqrt(n))
        half = (end - start) / 2
        value = lambda e: F.exp((n - 1) * F.log(F.greatest(F.cos(start + half * (e["a"] + 1)), F.lit(1e-300))))
        return half * F.aggregate(nodes, F.lit(0.0), lambda sum_, e: sum_ + e["w"] * value(e))

    p = F.least(F.lit(1.0), integral(F.atan2(F.abs(t), F.sqrt(n))) / integral(F.lit(0.0)))
    return F.when(F.isnan(t), F.lit(float("nan"))).when(t.isNotNull() & (dof > 0), p)


def cor_test_p(df: DataFrame, x: str, y: str, by: str | Sequence[str] | None = None) -> DataFrame:
    """``cor_test`` plus the two-sided ``p_value``."""
    res = cor_test(df, x, y, by)
    return res.withColumn("p_value", t_two_sided_p(F.col("statistic"), F.col("parameter")))


def loglog_fit(df: DataFrame, y: str, x: str, by: str | Sequence[str] | None = None) -> DataFrame:
    """Least-squares line of ``log10(y)`` on ``log10(x)`` per group."""
    keys = as_list(by)
    ly, lx = F.log10(F.col(y)), F.log10(F.col(x))
    return df.groupBy(*keys).agg(
        F.regr_intercept(ly, lx).alias("intercept"),
        F.regr_slope(ly, lx).alias("slope"),
        F.regr_r2(ly, lx).alias("r2"),
        F.regr_count(ly, lx).alias("n"),
    )


def histogram(df: DataFrame, x: str | F.Column, bins: int, hi: float,
              by: str | Sequence[str] | None = None) -> DataFrame:
    """Counts in ``bins`` equal bins over [0, hi]; values above ``hi`` are
    dropped (an axis limit)."""
    keys = as_list(by)
    val = F.col(x) if isinstance(x, str) else x
    width = hi / bins
    binned = df.withColumn("_x", val).filter(F.col("_x") <= hi)
    b = F.least(F.floor(F.col("_x") / F.lit(width)), F.lit(bins - 1)).cast("long")
    return binned.groupBy(*keys, b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))


def _holds(position) -> F.Column:
    """Whether a counted value covers a 1-based position of the sorted rows."""
    return (position <= F.col("_last")) & (position > F.col("_last") - F.col("_n"))


def five_number(df: DataFrame, x: str, by: str | Sequence[str] | None = None) -> DataFrame:
    """Exact min, quartiles (linear interpolation) and max per group.

    Values are counted first, so a value that many rows share is one row; the
    distinct values are numbered by a range sort and their counts summed up
    in that order, which tells which value holds each quantile position.  No
    group is gathered in a task.  Eager.
    """
    keys = as_list(by)
    counted = (df.select(*keys, F.col(x).alias("_x")).filter(F.col("_x").isNotNull())
                 .groupBy(*keys, "_x").agg(F.count(F.lit(1)).alias("_n")))
    ranked = row_number_by(counted, keys, [F.col("_x").asc()], "_i")
    summed = running_sum(ranked, "_n", keys, "_i", "_last")
    if keys:
        sizes = counted.groupBy(*keys).agg(F.sum("_n").alias("_cnt"))
        summed = null_safe_join(summed, measured(sizes), keys)
    else:
        summed = summed.withColumn("_cnt", counted.select(F.sum("_n")).scalar())
    names = ["minimum", "lower", "middle", "upper", "maximum"]
    aggs = []
    for q, name in zip((0.0, 0.25, 0.5, 0.75, 1.0), names):
        h = (F.col("_cnt") - 1) * F.lit(q)
        lo = F.floor(h) + 1
        hi = F.ceil(h) + 1
        frac = h - F.floor(h)
        aggs.append(F.max(F.when(_holds(lo), F.col("_x"))).alias(f"_{name}_lo"))
        aggs.append(F.max(F.when(_holds(hi), F.col("_x"))).alias(f"_{name}_hi"))
        aggs.append(F.max(frac).alias(f"_{name}_f"))
    picked = summed.groupBy(*keys).agg(*aggs)
    return picked.select(*keys, *[
        (F.col(f"_{n}_lo") + F.col(f"_{n}_f") * (F.col(f"_{n}_hi") - F.col(f"_{n}_lo"))).alias(n)
        for n in names])


def quantile_sketches(df: DataFrame, x: str, by: str | Sequence[str] | None = None, k: int = 4096) -> DataFrame:
    """``by, sketch``: the state of a KLL quantile sketch per group, a partial
    aggregate of bounded size that can be saved and merged later.  Larger
    ``k`` (8 to 65535) is more exact; up to ``k`` values a group nothing is
    lost.  Null values take no part; a group without values has none."""
    keys = as_list(by)
    return df.filter(F.col(x).isNotNull()).groupBy(*keys).agg(
        F.kll_sketch_agg_double(F.col(x).cast("double"), k).alias("sketch"))


def merge_sketches(sketches: DataFrame, by: str | Sequence[str] | None = None, k: int = 4096) -> DataFrame:
    """Saved sketches added up to coarser groups, without the values."""
    return sketches.groupBy(*as_list(by)).agg(F.kll_merge_agg_double("sketch", k).alias("sketch"))


def sketched_five_number(sketches: DataFrame, by: str | Sequence[str] | None = None) -> DataFrame:
    """The five numbers from sketches: least, quartiles and largest, each a
    value that occurs (the least value with at least that share of the values
    up to it)."""
    names = ["minimum", "lower", "middle", "upper", "maximum"]
    return sketches.filter(F.col("sketch").isNotNull()).select(*as_list(by), *[
        F.kll_sketch_get_quantile_double("sketch", F.lit(p)).alias(n) for p, n in zip((0.0, 0.25, 0.5, 0.75, 1.0), names)])


def trend(df: DataFrame, y: str | F.Column, x: str, by: str | Sequence[str] | None = None) -> DataFrame:
    """Linear trend of ``y`` over ``x`` per group (slope, intercept)."""
    keys = as_list(by)
    yc = F.col(y) if isinstance(y, str) else y
    return df.groupBy(*keys).agg(
        F.regr_slope(yc, F.col(x)).alias("slope"),
        F.regr_intercept(yc, F.col(x)).alias("intercept"),
        F.regr_count(yc, F.col(x)).alias("n"),
    )


def smooth(df: DataFrame, y: str | F.Column, x: str, by: str | Sequence[str] | None = None, span: float = 0.75,
           degree: int = 2, points: int = 80) -> DataFrame:
    """Local regression of ``y`` over ``x`` per group, at ``points`` equally
    spaced places from the least to the largest ``x``: columns ``by``, ``x``
    and ``fitted``.

    At each place the nearest ``span`` (0 to 1) of the rows count, with
    tricube weights by distance over the distance of the farthest of them; a
    polynomial of ``degree`` (0 to 2) is fitted by weighted least squares,
    of a lower degree where fewer values of ``x`` have a weight.  Where all of
    them are equally far, they weigh the same.

    Rows are first added up by value of ``x``, so the work is values x
    points; the reach of a place comes from a range sort by distance and a
    two-level running count, the fit from sums: no group is gathered.  Rows
    with a null ``x`` or ``y`` take no part.  Eager.
    """
    if not 0 < span <= 1 or degree not in (0, 1, 2):
        raise ValueError("span must be in (0, 1] and degree 0, 1 or 2")
    keys = as_list(by)
    yc = F.col(y) if isinstance(y, str) else y
    rows = df.select(*keys, F.col(x).cast("double").alias("_x"), yc.cast("double").alias("_y")) \
        .filter(F.col("_x").isNotNull() & F.col("_y").isNotNull())
    counted = materialize(rows.withColumn("_all", F.lit(0)).groupBy(*keys, "_all", "_x").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("_y").alias("_s")))
    group = [*keys, "_all"]
    step = F.lit(float(max(1, points - 1)))
    grid = counted.groupBy(*group).agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"), F.sum("_n").alias("_size")) \
        .select(*group, F.greatest(F.lit(1), F.floor(F.col("_size") * span + 1e-5)).cast("long").alias("_q"),
                "_lo", "_hi", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("_i")) \
        .withColumn("_at", F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_i") / step).drop("_lo", "_hi")
    near = null_safe_join(counted, measured(grid), group).withColumn("_d", F.abs(F.col("_x") - F.col("_at")))
    place = [*group, "_i"]
    ranked = row_number_by(near, place, [F.col("_d"), F.col("_x")], "_r")
    summed = materialize(running_sum(ranked, "_n", place, "_r", "_upto"))
    reach = summed.groupBy(*place).agg(F.min(F.when(F.col("_upto") >= F.col("_q"), F.col("_d"))).alias("_h"),
                                       F.min("_d").alias("_least"))
    z = F.when(F.col("_h") > 0, (F.col("_x") - F.col("_at")) / F.col("_h")).otherwise(0.0)
    u = F.abs(z)
    weight = F.when(F.col("_least") < F.col("_h"), F.when(u < 1, F.pow(1 - F.pow(u, 3), F.lit(3))).otherwise(0.0)) \
        .otherwise(F.when(F.col("_d") == F.col("_h"), 1.0).otherwise(0.0))
    weighted = null_safe_join(summed, measured(reach), place).withColumn("_z", z).withColumn("_w", weight) \
        .filter(F.col("_w") > 0)
    power = lambda k: F.pow("_z", F.lit(float(k))) if k else F.lit(1.0)
    sums = weighted.groupBy(*place).agg(
        F.first("_at").alias(x), F.count(F.lit(1)).alias("_values"),
        *[F.sum(F.col("_w") * F.col("_n") * power(k)).alias(f"_s{k}") for k in range(5)],
        *[F.sum(F.col("_w") * F.col("_s") * power(k)).alias(f"_t{k}") for k in range(3)])
    s, t = [F.col(f"_s{k}") for k in range(5)], [F.col(f"_t{k}") for k in range(3)]
    minor = s[2] * s[4] - s[3] * s[3]
    square = (t[0] * minor - s[1] * (t[1] * s[4] - t[2] * s[3]) + s[2] * (t[1] * s[3] - t[2] * s[2])) / (
        s[0] * minor - s[1] * (s[1] * s[4] - s[2] * s[3]) + s[2] * (s[1] * s[3] - s[2] * s[2]))
    line = (t[0] * s[2] - t[1] * s[1]) / (s[0] * s[2] - s[1] * s[1])
    fitted = F.when((F.col("_values") > 2) & F.lit(degree == 2), square) \
        .when((F.col("_values") > 1) & F.lit(degree > 0), line).otherwise(t[0] / s[0])
    return sums.select(*keys, x, fitted.alias("fitted"))
