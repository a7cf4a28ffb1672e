"""Non-parametric tests: ranks, Mann-Whitney, Yeo-Johnson, Shapiro-Wilk, QQ points."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from statistics import NormalDist

from tallyloom.functions.columns import yeo_johnson
from tallyloom.functions.normal import normal_quantile, plotting_position, upper_tail
from tallyloom.operators.order_statistics import running_totals
from tallyloom.session import stage

EXACT_SIZE = 8


def mann_whitney(df: DataFrame, value: str, group: str, first: str, second: str) -> DataFrame:
    """Two-sided Mann-Whitney U test of group ``first`` against ``second``, one row.

    Columns: n1, n2, u_statistic (of the first sample), z, p_value. Rows are
    reduced to one per distinct value before they are ranked; tied values take
    their average rank. The p-value uses the normal approximation with tie and
    continuity corrections, or the exact distribution when there is no tie, a
    sample has at most eight values, and n1 * n2 is at most 100,000.
    """
    in_group = df.filter(F.col(group).isin(first, second) & F.col(value).isNotNull())
    counted = in_group.groupBy(value).agg(
        F.count(F.when(F.col(group) == first, 1)).alias("a"), F.count(F.lit(1)).alias("t")
    )
    ranked = running_totals(counted, value, ["t"])
    t = F.col("t").cast("double")
    rank = F.col("before_t") + (t + 1) / 2
    sums = ranked.agg(
        F.sum("a").alias("n1"),
        F.sum(F.col("t") - F.col("a")).alias("n2"),
        F.sum(rank * F.col("a")).alias("rank_sum"),
        F.sum(t * t * t - t).alias("ties"),
    )
    n1, n2 = F.col("n1").cast("double"), F.col("n2").cast("double")
    n = n1 + n2
    u = F.col("rank_sum") - n1 * (n1 + 1) / 2
    variance = n1 * n2 / 12 * ((n + 1) - F.try_divide(F.col("ties"), n * (n - 1)))
    larger = F.greatest(u, n1 * n2 - u)
    z = F.try_divide(larger - n1 * n2 / 2 - 0.5, F.sqrt(variance))
    return sums.select("n1", "n2", u.alias("u_statistic"), z.alias("z"), "ties").select(
        "n1", "n2", "u_statistic", "z", _p_value("n1", "n2", "u_statistic", "z", "ties").alias("p_value")
    )


@F.pandas_udf(T.DoubleType())
def _p_value(n1: pd.Series, n2: pd.Series, u: pd.Series, z: pd.Series, ties: pd.Series) -> pd.Series:
    """p of the single summary row."""

    def one(a, b, u_value, z_value, tied) -> float:
        if tied == 0 and min(a, b) <= EXACT_SIZE and a * b <= 100_000:
            return exact_mann_whitney_p(int(a), int(b), max(u_value, a * b - u_value))
        return min(1.0, 2 * upper_tail(z_value)) if z_value == z_value else 1.0

    return pd.Series([one(*row) for row in zip(n1, n2, u, z, ties)])


def exact_mann_whitney_p(n1: int, n2: int, larger_u: float) -> float:
    """Two-sided exact p without ties: the distribution of U by counting partitions into an n1 x n2 box."""
    ways = np.zeros(n1 * n2 + 1)
    ways[0] = 1.0
    for i in range(1, n1 + 1):
        # Multiply by (1 - q^(n2+i)), divide by (1 - q^i).
        lifted = ways.copy()
        lifted[n2 + i:] -= ways[: len(ways) - n2 - i]
        for j in range(i, len(lifted)):
            lifted[j] += lifted[j - i]
        ways = lifted
    return min(1.0, 2 * ways[math.ceil(larger_u):].sum() / ways.sum())


def _per_group(group: str, values: dict[str, Column]) -> Column:
    """A constant per group, as one literal map."""
    return F.create_map(*[x for g, v in values.items() for x in (F.lit(g), v)])[F.col(group)]


def yeo_johnson_powers(df: DataFrame, value: str, group: str, labels: list[str], rounds: int = 8) -> dict[str, float]:
    """Maximum-likelihood Yeo-Johnson exponent of each labelled group.

    Each round evaluates a grid of 21 exponents per group in one aggregate over the
    distinct values and their counts, then narrows the grid around the best.
    """
    kept = df.filter(F.col(group).isin(labels) & F.col(value).isNotNull())
    x = F.col("_x")
    counted = stage(kept.groupBy(group, F.col(value).cast("double").alias("_x")).agg(F.count(F.lit(1)).alias("_n")))
    n = F.col("_n")
    base = {
        r[group]: r
        for r in counted.groupBy(group)
        .agg(
            F.sum(n).alias("n"),
            (F.sum(n * x) / F.sum(n)).alias("mean"),
            F.sum(n * F.signum(x) * F.log1p(F.abs(x))).alias("jacobian"),
        )
        .collect()
    }
    found = [label for label in labels if label in base]
    steps = 20
    low, high = {g: -4.0 for g in found}, {g: 6.0 for g in found}
    best = {g: 1.0 for g in found}
    for _ in range(rounds):
        grid = {g: [low[g] + (high[g] - low[g]) * i / steps for i in range(steps + 1)] for g in found}
        points = {g: F.array(*[F.struct(F.lit(i).alias("i"), F.lit(p).alias("power")) for i, p in enumerate(grid[g])]) for g in found}
        centre = _per_group(group, {g: F.lit(base[g]["mean"]) for g in found})
        # Centred near the mean, so that the variance does not cancel.
        y = yeo_johnson(x, F.col("power")) - yeo_johnson(F.col("_centre"), F.col("power"))
        sums = (
            counted.select(group, "_x", "_n", centre.alias("_centre"), F.inline(_per_group(group, points)))
            .select(group, "i", n.alias("n"), y.alias("y"))
            .groupBy(group, "i")
            .agg(F.sum(F.col("n") * F.col("y")).alias("s"), F.sum(F.col("n") * F.col("y") * F.col("y")).alias("q"))
        )
        cells = {(r[group], r["i"]): r for r in sums.collect()}
        for g in found:
            size = base[g]["n"]

            def likelihood(i: int) -> float:
                cell = cells[g, i]
                variance = cell["q"] / size - (cell["s"] / size) ** 2
                if not variance > 0:
                    return -math.inf
                return -size / 2 * math.log(variance) + (grid[g][i] - 1) * base[g]["jacobian"]

            top = max(range(steps + 1), key=likelihood)
            best[g] = grid[g][top]
            step = (high[g] - low[g]) / steps
            # At an end of the grid, go on beyond it with the same width.
            reach = step * steps / 2 if top in (0, steps) else step
            low[g], high[g] = best[g] - reach, best[g] + reach
    return best


def yeo_johnson_transformed(df: DataFrame, value: str, group: str, powers: dict[str, float], name: str) -> DataFrame:
    """Add ``name``: the value under its group's exponent."""
    x = F.col(value).cast("double")
    return df.withColumn(name, yeo_johnson(x, _per_group(group, {g: F.lit(p) for g, p in powers.items()})))


def shapiro_from_sums(n: int, spread: float, mm: float, mx: float, ends: Sequence[tuple[float, float]]) -> tuple[float, float]:
    """W and p of the Shapiro-Wilk test (Royston 1995).

    ``mm`` and ``mx`` sum the squared normal scores and the scores times the ordered
    values; ``ends`` holds score and value of the second and first from the top and,
    negated, of the second and first from the bottom. Above 5,000 values p is an extrapolation.
    """
    if n < 3:
        return float("nan"), float("nan")
    if spread == 0:
        return 1.0, 1.0
    (next_m, next_x), (last_m, last_x) = ((m, top + bottom) for (m, top), (_, bottom) in zip(ends[:2], ends[2:]))
    if n == 3:
        total = math.sqrt(0.5) * last_x
    else:
        u = 1 / math.sqrt(n)
        # Royston's polynomial coefficients.
        last = last_m / math.sqrt(mm) + np.polyval([-2.706056, 4.434685, -2.071190, -0.147981, 0.221157, 0.0], u)
        if n > 5:
            before = next_m / math.sqrt(mm) + np.polyval([-3.582633, 5.682633, -1.752461, -0.293762, 0.042981, 0.0], u)
            phi = (mm - 2 * last_m**2 - 2 * next_m**2) / (1 - 2 * last**2 - 2 * before**2)
            total = (mx - last_m * last_x - next_m * next_x) / math.sqrt(phi) + last * last_x + before * next_x
        else:
            phi = (mm - 2 * last_m**2) / (1 - 2 * last**2)
            total = (mx - last_m * last_x) / math.sqrt(phi) + last * last_x
    w = min(total**2 / spread, 1.0)
    if n == 3:
        p = 6 / math.pi * (math.asin(math.sqrt(w)) - math.asin(math.sqrt(0.75)))
        return w, max(p, 0.0)
    if w >= 1.0:
        return w, 1.0
    # Royston's normalising polynomials.
    if n <= 11:
        y = -math.log(-2.273 + 0.459 * n - math.log(1 - w))
        mean = np.polyval([-0.0006714, 0.025054, -0.39978, 0.5440], n)
        deviation = math.exp(np.polyval([-0.0020322, 0.062767, -0.77857, 1.3822], n))
    else:
        y, log_n = math.log(1 - w), math.log(n)
        mean = np.polyval([0.0038915, -0.083751, -0.31082, -1.5861], log_n)
        deviation = math.exp(np.polyval([0.0030302, -0.082676, -0.4803], log_n))
    return w, upper_tail((y - mean) / deviation)


def shapiro_statistic(values: np.ndarray) -> tuple[float, float]:
    """W and p of the Shapiro-Wilk test for an array."""
    x = np.sort(np.asarray(values, dtype=float))
    n = len(x)
    m = np.array([NormalDist().inv_cdf((i - 0.375) / (n + 0.25)) for i in range(1, n + 1)])
    ends = [] if n < 2 else [(m[-2], x[-2]), (m[-1], x[-1]), (m[-2], -x[1]), (m[-1], -x[0])]
    return shapiro_from_sums(n, ((x - x.mean()) ** 2).sum() if n else 0.0, (m * m).sum(), (m * x).sum(), ends)


def shapiro_wilk(df: DataFrame, value: str, group: str) -> DataFrame:
    """Shapiro-Wilk test per group on all its values: (group, n, shapiro_statistic, shapiro_p_value).

    Ranks come from running counts over the distinct values and the statistic from sums
    over the ranks, so no task holds a group. The groups are labels, few by their nature;
    each takes a pass.
    """
    named = stage(df.select(group, F.col(value).cast("double").alias("_v")).filter(f"_v is not null AND `{group}` IS NOT NULL"))
    rows = []
    for label in [r[0] for r in named.select(group).distinct().orderBy(group).collect()]:
        counted = named.filter(F.col(group) == label).groupBy(F.col("_v").alias("ordered")).agg(F.count(F.lit(1)).alias("c"))
        ranked = running_totals(counted, "ordered", ["c"])
        about = ranked.agg(F.sum("c").alias("n"), (F.sum(F.col("c") * F.col("ordered")) / F.sum("c")).alias("mean")).first()
        n = about["n"]
        m, x, r = normal_quantile((F.col("r") - 0.375) / F.lit(n + 0.25)), F.col("ordered"), F.col("r")
        at = lambda rank: F.max(F.when(r == rank, x))  # noqa: E731, B023
        score = lambda rank: F.max(F.when(r == rank, F.col("m")))  # noqa: E731, B023
        sums = ranked_rows(ranked, n).withColumn("m", m).agg(
            F.sum((x - F.lit(about["mean"])) ** 2).alias("spread"), F.sum(F.col("m") ** 2).alias("mm"), F.sum(F.col("m") * x).alias("mx"),
            score(n - 1).alias("m1"), score(n).alias("m0"), at(n - 1).alias("x1"), at(n).alias("x0"), at(2).alias("y1"), at(1).alias("y0"),
        ).first()
        ends = [(sums["m1"], sums["x1"]), (sums["m0"], sums["x0"]), (sums["m1"], -(sums["y1"] or 0.0)), (sums["m0"], -sums["y0"])]
        rows.append((label, n, *map(float, shapiro_from_sums(n, sums["spread"], sums["mm"], sums["mx"], ends))))
    return df.sparkSession.createDataFrame(rows, f"`{group}` string, n bigint, shapiro_statistic double, shapiro_p_value double")


def ranked_rows(ranked: DataFrame, n: int) -> DataFrame:
    """A row (``ordered``, rank ``r``) for each of the ``c`` occurrences of a value, made in pieces so that a hot value's are made by many tasks."""
    piece = 100_000
    pieces = ranked.withColumn("start", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("c") - 1, F.lit(piece).cast("bigint"))))
    if n > piece:
        pieces = pieces.repartition(math.ceil(n / (10 * piece)) + 1, "ordered", "start")
    rank = F.explode(F.sequence(F.col("start") + 1, F.least(F.col("start") + piece, F.col("c"))))
    return pieces.select("ordered", "before_c", rank.alias("_r")).select("ordered", (F.col("before_c") + F.col("_r")).alias("r"))


def qq_points(df: DataFrame, value: str, label: str | None = None) -> DataFrame:
    """One point (theoretical, ordered[, label]) per non-null row against normal quantiles.

    Ranks come from running counts over the distinct values; a value that occurs
    c times is expanded to its c ranks at the very end, in pieces, so that a hot
    value's points are made by many tasks.
    """
    counted = stage(df.filter(F.col(value).isNotNull()).groupBy(F.col(value).alias("ordered")).agg(F.count(F.lit(1)).alias("c")))
    ranked = running_totals(counted, "ordered", ["c"])
    n = counted.agg(F.sum("c")).first()[0] or 0
    points = ranked_rows(ranked, n)
    position = plotting_position(F.col("r"), F.lit(float(n)))
    columns = [normal_quantile(F.col("p")).alias("theoretical"), F.col("ordered")]
    if label is not None:
        columns.append(F.lit(label).alias("discount_type"))
    return points.select("ordered", position.alias("p")).select(*columns)


def qq_line(points: DataFrame) -> DataFrame:
    """Least-squares line through QQ points: slope, intercept, r."""
    return points.agg(
        F.regr_slope("ordered", "theoretical").alias("slope"),
        F.regr_intercept("ordered", "theoretical").alias("intercept"),
        F.corr("ordered", "theoretical").alias("r"),
    )
