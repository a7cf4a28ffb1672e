"""Pearson correlations in long form."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def correlation_pairs(df: DataFrame, columns: Sequence[str], diagonal: bool = False) -> DataFrame:
    """Correlation of every unordered column pair as (feature_a, feature_b, corr).

    All pairs come from one aggregate over one scan; a pair ignores the rows
    where either of its columns is null. The number of pairs depends on the
    column list only.
    """
    pairs = list(combinations(columns, 2)) + ([(c, c) for c in columns] if diagonal else [])
    cells = [
        F.struct(
            F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"),
            F.corr(F.col(f"`{a}`").cast("double"), F.col(f"`{b}`").cast("double")).alias("corr"),
        )
        for a, b in pairs
    ]
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def correlated_pairs(df: DataFrame, columns: Sequence[str], target: str, threshold: float = 50.0) -> DataFrame:
    """Pairs whose absolute correlation in percent exceeds ``threshold``, each with its correlation to ``target``."""
    percent = F.abs("corr") * 100
    pairs = correlation_pairs(df, [*columns, target] if target not in columns else columns, diagonal=True)
    pairs = pairs.withColumn("corr_percent", percent)
    # One map from feature to its correlation with the target, inside the single aggregated row.
    entries = F.when(
        F.col("feature_a") == target, F.struct(F.col("feature_b").alias("k"), F.col("corr_percent").alias("v"))
    ).when(F.col("feature_b") == target, F.struct(F.col("feature_a").alias("k"), F.col("corr_percent").alias("v")))
    to_target = F.map_from_entries(F.col("entries"))
    packed = pairs.agg(
        F.collect_list(entries).alias("entries"),
        F.collect_list(F.struct("feature_a", "feature_b", "corr_percent")).alias("pairs"),
    )
    return (
        packed.select(to_target.alias("to_target"), F.inline("pairs"))
        .filter((F.col("feature_a") != F.col("feature_b")) & (F.col("corr_percent") > threshold))
        .select(
            "feature_a", "feature_b", "corr_percent",
            F.col("to_target")[F.col("feature_a")].alias("target_percent_a"),
            F.col("to_target")[F.col("feature_b")].alias("target_percent_b"),
        )
    )
