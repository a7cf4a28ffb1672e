"""Grouped aggregates, contingency tables, shares and top-k grouping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sums_by(df: DataFrame, key: str, measures: Sequence[str]) -> DataFrame:
    """Sum of each measure per key; a group of nulls sums to 0."""
    return df.groupBy(key).agg(*[F.coalesce(F.sum(m), F.lit(0.0)).alias(m) for m in measures])


def count_by(df: DataFrame, keys: Sequence[str], counted: str | None, name: str) -> DataFrame:
    """Rows per key combination, or non-null values of ``counted``."""
    return df.groupBy(*keys).agg(F.count(F.col(counted) if counted else F.lit(1)).alias(name))


def pivot_counts(
    df: DataFrame, key: str, column: str, values: Sequence, counted: str, prefix: str, kind: str = "double"
) -> DataFrame:
    """One column ``prefix + value`` per listed value, holding the count of ``counted``; 0 where absent.

    One grouped aggregate with conditional counts, so the width is known before
    the job runs and each input row is shuffled at most as a partial count.
    """
    return df.groupBy(key).agg(
        *[
            F.count(F.when(F.col(column) == value, F.col(counted))).cast(kind).alias(f"{prefix}{value}")
            for value in values
        ]
    )


def moments_by(df: DataFrame, key: str, value: str) -> DataFrame:
    """Mean and sample standard deviation per key (the median comes from the order statistics)."""
    return df.groupBy(key).agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("std_dev"))


def frequencies(df: DataFrame, columns: Sequence[str], hue: str | None = None) -> DataFrame:
    """Counts per value of every listed column, long form (column, value[, hue], count). Nulls are left out."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    extra = [F.col(hue).alias("hue")] if hue else []
    long = df.select(*extra, F.inline(pairs)).filter(F.col("value").isNotNull())
    return long.groupBy("column", "value", *(["hue"] if hue else [])).agg(F.count(F.lit(1)).alias("count"))


def levels_of(df: DataFrame, column: str) -> list:
    """The different values of a label column in order, nulls left out; as many as become columns."""
    return [r[0] for r in df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column).collect()]


def crosstab(df: DataFrame, row: str, column: str, values: Sequence[str] | None = None) -> DataFrame:
    """Contingency table with one column per value, listed or found in the data."""
    values = levels_of(df, column) if values is None else values
    return df.groupBy(row).agg(*[F.count(F.when(F.col(column) == v, 1)).alias(str(v)) for v in values])


def share_within(df: DataFrame, group: str, count: str, name: str) -> DataFrame:
    """Share of ``count`` within its group. Meant for already aggregated input."""
    totals = df.groupBy(group).agg(F.sum(count).alias("_total"))
    return df.join(totals, group).withColumn(name, F.col(count) / F.col("_total")).drop("_total")


def share_of_total(df: DataFrame, count: str, name: str) -> DataFrame:
    """Share of ``count`` in the sum over all rows."""
    total = df.agg(F.sum(count)).scalar()
    return df.withColumn(name, F.col(count) / total)


def top_values(df: DataFrame, column: str, k: int) -> DataFrame:
    """The ``k`` most frequent values with their counts; ties go to the smaller value."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.desc("count"), column).limit(k)


def group_rare(df: DataFrame, column: str, k: int, name: str, other: str = "Other") -> DataFrame:
    """Keep the ``k`` most frequent values of ``column``; the rest become ``other``.

    The kept list has ``k`` entries and comes in as a scalar subquery, so the
    rows are neither collected nor joined.
    """
    kept = top_values(df, column, k).agg(F.collect_list(column)).scalar()
    return df.withColumn(name, F.when(F.array_contains(kept, F.col(column)), F.col(column)).otherwise(other))


def profile_by(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Size, mean, minimum and maximum of each column per group."""
    parts: list[Column] = [F.count(F.lit(1)).alias("customers")]
    for c in columns:
        parts += [F.avg(c).alias(f"{c}_mean"), F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")]
    return df.groupBy(key).agg(*parts)


