"""Scalers fitted on one frame and applied to another."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.order_statistics import indicator_quantiles, quantile_values


@dataclass(frozen=True)
class Scaling:
    """Per column an offset and a scale: ``(x - offset) / scale``, after a shifted log if ``log`` is set."""

    offsets: dict[str, float]
    scales: dict[str, float]
    log: bool = False
    shift: float = 0.0

    def transform(self, df: DataFrame) -> DataFrame:
        """Replace each fitted column by its scaled value."""
        return df.withColumns({c: self._scaled(c) for c in self.offsets})

    def _scaled(self, c: str):
        x = F.ln(F.col(f"`{c}`") + F.lit(self.shift)) if self.log else F.col(f"`{c}`")
        return (x - F.lit(self.offsets[c])) / F.lit(self.scales[c])

    def inverse(self, df: DataFrame) -> DataFrame:
        """Undo :meth:`transform`."""
        columns = {}
        for c in self.offsets:
            x = F.col(f"`{c}`") * F.lit(self.scales[c]) + F.lit(self.offsets[c])
            columns[c] = F.exp(x) - F.lit(self.shift) if self.log else x
        return df.withColumns(columns)


def _scaling(columns: Sequence[str], offsets, spreads, **options) -> Scaling:
    # A column without spread is only shifted, never divided by zero.
    scales = {c: float(s) if s else 1.0 for c, s in zip(columns, spreads)}
    return Scaling({c: float(o or 0.0) for c, o in zip(columns, offsets)}, scales, **options)


def fit_robust(df: DataFrame, columns: Sequence[str], indicators: Sequence[str] = ()) -> Scaling:
    """Median and interquartile range, both exact. ``indicators`` names the 0/1 columns, which need only be counted."""
    probs = [0.25, 0.5, 0.75]
    q = quantile_values(df, [c for c in columns if c not in indicators], probs)
    if indicators:
        q |= indicator_quantiles(df, indicators, probs)
    return _scaling(
        columns, [q.get((c, 0.5)) for c in columns],
        [q.get((c, 0.75), 0.0) - q.get((c, 0.25), 0.0) for c in columns],
    )


def fit_minmax(df: DataFrame, columns: Sequence[str]) -> Scaling:
    """Minimum to 0, maximum to 1."""
    row = df.agg(*[f(f"`{c}`").alias(f"{n}_{c}") for c in columns for n, f in (("lo", F.min), ("hi", F.max))]).first()
    return _scaling(columns, [row[f"lo_{c}"] for c in columns], [(row[f"hi_{c}"] or 0) - (row[f"lo_{c}"] or 0) for c in columns])


def fit_log_minmax(df: DataFrame, columns: Sequence[str], shift: float = 0.0) -> Scaling:
    """Natural log of the shifted value, then minimum to 0 and maximum to 1; no value at or below zero."""
    logs = df.select(*[F.ln(F.col(f"`{c}`") + F.lit(shift)).alias(c) for c in columns])
    fitted = fit_minmax(logs, columns)
    return Scaling(fitted.offsets, fitted.scales, log=True, shift=shift)


def fit_standard(df: DataFrame, columns: Sequence[str]) -> Scaling:
    """Mean and population standard deviation."""
    row = df.agg(
        *[f(f"`{c}`").alias(f"{n}_{c}") for c in columns for n, f in (("mean", F.avg), ("sd", F.stddev_pop))]
    ).first()
    return _scaling(columns, [row[f"mean_{c}"] for c in columns], [row[f"sd_{c}"] for c in columns])
