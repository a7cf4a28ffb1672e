"""The numbers behind the charts: histograms, densities, box plots, scatter points."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.order_statistics import exact_quantiles
from tallyloom.session import checked_broadcast


def _long(df: DataFrame, columns: Sequence[str], by: str | None = None) -> DataFrame:
    """Rows ([by,] column, value) without nulls."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
    keys = [F.col(by)] if by else []
    return df.select(*keys, F.inline(pairs)).filter(F.col("value").isNotNull())


def _by_name(values: dict[str, float]) -> Column:
    return F.create_map(*[x for c, v in values.items() for x in (F.lit(c), F.lit(v))])[F.col("column")]


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 30, log_positive: bool = True) -> DataFrame:
    """Equal-width counts per column as (column, bin, low, high, is_log, count); empty bins count 0.

    A column whose minimum is positive is binned on its natural logarithm if
    ``log_positive``; ``low`` and ``high`` are in the column's own unit. The
    maximum belongs to the last bin. Rows are counted before they are shuffled,
    so at most ``bins`` rows per column and task travel.
    """
    row = df.agg(*[f(F.col(c).cast("double")).alias(f"{n}_{c}") for c in columns for n, f in (("lo", F.min), ("hi", F.max))]).first()
    filled = [c for c in columns if row[f"lo_{c}"] is not None]
    logged = {c: bool(log_positive and row[f"lo_{c}"] > 0) for c in filled}
    edge = lambda n: _by_name({c: row[f"{n}_{c}"] for c in filled})
    is_log = _by_name(logged)
    unit = lambda x: F.when(is_log, F.ln(x)).otherwise(x)
    low, high = unit(edge("lo")), unit(edge("hi"))
    width = F.when(high > low, high - low).otherwise(F.lit(1.0))
    bin_number = F.least(F.floor((unit(F.col("value")) - low) / width * bins), F.lit(bins - 1)).cast("int")
    counts = _long(df, filled).select("column", bin_number.alias("bin")).groupBy("column", "bin").agg(F.count(F.lit(1)).alias("count"))
    grid = df.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(c) for c in filled])).alias("column")
    ).withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    at = lambda b: low + width * b / F.lit(float(bins))
    back = lambda x: F.when(is_log, F.exp(x)).otherwise(x)
    return grid.join(counts, ["column", "bin"], "left").select(
        "column", "bin", back(at(F.col("bin"))).alias("low"), back(at(F.col("bin") + 1)).alias("high"),
        is_log.alias("is_log"), F.coalesce("count", F.lit(0)).cast("bigint").alias("count"),
    )


def kernel_density(df: DataFrame, column: str, bins: int = 200, grid_points: int = 100) -> DataFrame:
    """Gaussian kernel density on an even grid, from a fine histogram: (x, density).

    The bandwidth is Scott's rule, the sample deviation times n^(-1/5). Work
    after the one counting pass is ``bins`` times ``grid_points``.
    """
    x = F.col(column).cast("double")
    row = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi"), F.stddev_samp(x).alias("sd"), F.count(x).alias("n")).first()
    width = (row["hi"] - row["lo"]) or 1.0
    bandwidth = (row["sd"] or 1.0) * row["n"] ** -0.2
    number = F.least(F.floor((x - row["lo"]) / width * bins), F.lit(bins - 1))
    counts = df.filter(x.isNotNull()).groupBy(number.alias("bin")).agg(F.count(F.lit(1)).alias("c"))
    centre = F.lit(row["lo"]) + (F.col("bin") + 0.5) * (width / bins)
    start, stop = row["lo"] - 3 * bandwidth, row["hi"] + 3 * bandwidth
    point = F.lit(start) + F.col("g") * ((stop - start) / (grid_points - 1))
    kernel = F.exp(F.lit(-0.5) * F.pow((point - centre) / bandwidth, F.lit(2.0)))
    scale = row["n"] * bandwidth * 2.5066282746310002
    return (
        counts.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(grid_points - 1))))
        .groupBy(F.col("g").alias("point"))
        .agg(F.first(point).alias("x"), (F.sum(F.col("c") * kernel) / scale).alias("density"))
    )


def box_stats(df: DataFrame, columns: Sequence[str], by: str | None = None) -> DataFrame:
    """Exact quartiles, whiskers at 1.5 times the interquartile range and outlier counts, per column [and group]."""
    group = [by] if by else []
    quartiles = (
        exact_quantiles(df, columns, [0.25, 0.5, 0.75], by=by)
        .groupBy(*group, "column")
        .agg(*[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n) for n, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))])
    )
    quartiles = checked_broadcast(quartiles)
    reach = F.lit(1.5) * (F.col("q3") - F.col("q1"))
    inside = F.col("value").between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        _long(df, columns, by)
        .join(quartiles, [*group, "column"])
        .groupBy(*group, "column", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.count(F.when(~inside, 1)).alias("outliers"),
        )
    )


def scatter_points(df: DataFrame, row_id: str, columns: Sequence[str]) -> DataFrame:
    """Every point of a scatter matrix: a row per point, of which each pair of columns is one chart."""
    return df.select(row_id, *columns)


def midpoint_outlier_filter(df: DataFrame, column: str) -> DataFrame:
    """Keep rows within 1.5 interquartile ranges of the quartiles, which are midpoints of their neighbours."""
    q = {r["prob"]: r["value"] for r in exact_quantiles(df, [column], [0.25, 0.75], interpolation="midpoint").collect()}
    reach = 1.5 * (q[0.75] - q[0.25])
    return df.filter(F.col(column).between(q[0.25] - reach, q[0.75] + reach))
