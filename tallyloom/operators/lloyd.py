"""K-means for many k at once: every pass over the rows serves all of them.

A pass sends the centres of all k to the tasks and gets back, per k and centre, the
number of rows, their sum and their sum of squared distances, added up per batch first. So
a sweep over k takes as many passes as its slowest k, and what moves depends on the
centres alone, never on the rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.session import stage

#: Rounds of seeding; a round draws about 2 * max(k) rows, each by its squared distance to those before.
SEED_ROUNDS = 5
#: Starts that are tried on the weighted seeds for each k; the best by cost goes on.
STARTS = 8
# Rows whose distances to all centres are held at a time.
SLICE_ROWS = 4096

Centres = dict[int, np.ndarray]


def points_of(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns as one array column ``x``, staged. A null is an error in the passes."""
    return stage(df.select(F.array(*[F.col(c).cast("double") for c in columns]).alias("x")))


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    d = (x * x).sum(axis=1)[:, None] + (centres * centres).sum(axis=1)[None, :] - 2.0 * (x @ centres.T)
    return np.maximum(d, 0.0)


def _slices(batches: Iterator[pd.DataFrame], centre: np.ndarray) -> Iterator[np.ndarray]:
    for batch in batches:
        for start in range(0, len(batch), SLICE_ROWS):
            x = np.stack(batch["x"].iloc[start : start + SLICE_ROWS].to_numpy()).astype(float) - centre
            if np.isnan(x).any():
                raise ValueError("a feature is null or NaN")
            yield x


def assign(points: DataFrame, middle: np.ndarray, centres: Centres) -> pd.DataFrame:
    """One pass: (k, centre, n, cost, squares, sums) of the rows nearest to each centre; ties go to the first.

    ``cost`` is the sum of squared distances to the centre, ``squares`` that to ``middle``.
    """

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = {k: np.zeros((len(c), c.shape[1] + 3)) for k, c in centres.items()}
        for x in _slices(batches, middle):
            square = (x * x).sum(axis=1)
            for k, c in centres.items():
                nearest = _squares(x, c).argmin(axis=1)
                cost = ((x - c[nearest]) ** 2).sum(axis=1)
                for i, column in enumerate([None, cost, square, *x.T]):
                    total[k][:, i] += np.bincount(nearest, column, len(c))
        for k, rows in total.items():
            used = np.flatnonzero(rows[:, 0])
            if not len(used):
                continue
            yield pd.DataFrame({
                "k": np.full(len(used), k), "centre": used, "n": rows[used, 0], "cost": rows[used, 1],
                "squares": rows[used, 2], "sums": list(rows[used, 3:]),
            })

    partial = points.mapInPandas(sums, "k long, centre long, n double, cost double, squares double, sums array<double>")
    width = len(middle)
    added = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)]
    grouped = partial.groupBy("k", "centre").agg(
        F.sum("n").alias("n"), F.sum("cost").alias("cost"), F.sum("squares").alias("squares"), *added
    )
    # One row a centre.
    rows = grouped.select("k", "centre", "n", "cost", "squares", F.array(*[f"s{i}" for i in range(width)]).alias("sums")).toPandas()
    return rows.sort_values(["k", "centre"], ignore_index=True)


def _seeds(points: DataFrame, middle: np.ndarray, most: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Candidate centres with the rows next to each, over all rows: draws in proportion to the squared distance."""
    found = np.zeros((1, len(middle)))
    for turn in range(SEED_ROUNDS):
        cost = assign(points, middle, {0: found})["cost"].sum()
        if cost <= 0:
            break

        def draw(batches: Iterator[pd.DataFrame], found=found, cost=cost, turn=turn) -> Iterator[pd.DataFrame]:
            rng = np.random.default_rng([seed, turn, TaskContext.get().partitionId()])
            for x in _slices(batches, middle):
                chance = 2.0 * most * _squares(x, found).min(axis=1) / cost
                kept = x[rng.random(len(x)) < chance]
                if len(kept):
                    yield pd.DataFrame({"x": list(kept)})

        drawn = points.mapInPandas(draw, "x array<double>").distinct().toPandas()["x"]
        if len(drawn):
            # In an order of their own, so that the partitions' order of arrival does not matter.
            found = np.unique(np.vstack([found, np.stack(drawn.to_numpy())]), axis=0)
    weights = np.zeros(len(found))
    last = assign(points, middle, {0: found})
    weights[last["centre"]] = last["n"]
    return found[weights > 0], weights[weights > 0]


def _start(found: np.ndarray, weights: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """At most ``k`` of the weighted seeds, far from one another, moved to their means: the best of a few tries."""
    best, least = found[:0], np.inf
    for _ in range(STARTS):
        chosen = [rng.choice(len(found), p=weights / weights.sum())]
        near = _squares(found, found[chosen])[:, 0]
        while len(chosen) < k and (near * weights).sum() > 0:
            chosen.append(rng.choice(len(found), p=near * weights / (near * weights).sum()))
            near = np.minimum(near, _squares(found, found[chosen[-1:]])[:, 0])
        centres = found[chosen]
        for _ in range(30):
            own = _squares(found, centres).argmin(axis=1)
            moved = np.stack([
                np.average(found[own == i], axis=0, weights=weights[own == i]) if (own == i).any() else c
                for i, c in enumerate(centres)
            ])
            if np.array_equal(moved, centres):
                break
            centres = moved
        cost = (_squares(found, centres).min(axis=1) * weights).sum()
        if cost < least:
            best, least = centres, cost
    return best


def fit_all(
    points: DataFrame, ks: Sequence[int], max_iter: int = 1000, seed: int = 0, tolerance: float = 1e-4
) -> tuple[np.ndarray, Centres, pd.DataFrame, int]:
    """Centres for every k: (middle, centres less the middle, the last pass's sums, passes of descent).

    A k stops once no centre moves by more than ``tolerance`` of the deviation of the
    rows, or after ``max_iter`` passes; the others go on without it. There are fewer than k centres
    where the rows have fewer distinct values. No rows give no centres.
    """
    width = len(points.select("x").first()["x"]) if not points.isEmpty() else 0
    if not width:
        return np.zeros(0), {int(k): np.zeros((0, 0)) for k in ks}, pd.DataFrame(columns=["k", "centre", "n", "cost", "squares", "sums"]), 0
    means = points.agg(*[F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(width)]).first()
    middle = np.array([np.nan if m is None else m for m in means], dtype=float)
    found, weights = _seeds(points, middle, max(ks), seed)
    centres = {int(k): _start(found, weights, int(k), np.random.default_rng([seed, int(k)])) for k in ks}
    going, passes = set(centres), 0
    spread = None
    while going and passes < max_iter:
        sums = assign(points, middle, {k: centres[k] for k in going})
        passes += 1
        if spread is None:
            one = sums[sums["k"] == min(going)]
            spread = float(np.sqrt(one["squares"].sum() / one["n"].sum()))
        for k, rows in sums.groupby("k"):
            moved = centres[k].copy()
            moved[rows["centre"].to_numpy()] = np.stack(rows["sums"].to_numpy()) / rows["n"].to_numpy()[:, None]
            step = np.sqrt(((moved - centres[k]) ** 2).sum(axis=1)).max()
            centres[k] = moved
            if step <= tolerance * spread:
                going.discard(k)
    return middle, centres, assign(points, middle, centres), passes


def silhouettes(points: DataFrame, middle: np.ndarray, centres: Centres, sums: pd.DataFrame) -> dict[int, float | None]:
    """Mean silhouettes on squared distances of every k, in one pass; null for fewer than two clusters.

    The mean squared distance of x to a cluster of mean m and mean square s is
    |x|^2 - 2 x.m + s. A row alone in its cluster scores 0.
    """
    known = {}
    for k, rows in sums.groupby("k"):
        n = rows["n"].to_numpy()
        if len(n) > 1:
            means = np.stack(rows["sums"].to_numpy()) / n[:, None]
            known[int(k)] = (rows["centre"].to_numpy(), n, means, rows["squares"].to_numpy() / n)
    if not known:
        return {int(k): None for k in centres}

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = {k: np.zeros(2) for k in known}
        for x in _slices(batches, middle):
            square = (x * x).sum(axis=1)
            for k, (names, n, means, mean_squares) in known.items():
                own = np.searchsorted(names, _squares(x, centres[k]).argmin(axis=1))
                apart = np.maximum(square[:, None] - 2.0 * (x @ means.T) + mean_squares, 0.0)
                at = np.arange(len(x)), own
                inside = apart[at] * n[own] / np.maximum(n[own] - 1, 1)
                apart[at] = np.inf
                outside = apart.min(axis=1)
                larger = np.maximum(inside, outside)
                value = np.where((n[own] > 1) & (larger > 0), (outside - inside) / np.where(larger > 0, larger, 1.0), 0.0)
                total[k] += len(x), value.sum()
        yield pd.DataFrame([(k, *map(float, t)) for k, t in total.items()], columns=["k", "n", "value"])

    scored = points.mapInPandas(score, "k long, n double, value double").groupBy("k").agg((F.sum("value") / F.sum("n")).alias("s"))
    values = {r["k"]: r["s"] for r in scored.collect()}
    return {int(k): values.get(int(k)) for k in centres}
