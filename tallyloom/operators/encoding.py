"""Encoders: dummies, one-hot vectors, integer labels, group statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.columns import columns_with_prefix, first_largest
from tallyloom.session import checked_broadcast

# Most levels a column may have before it is refused as a categorical.
MAX_LEVELS = 1_000


def fit_levels(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Sorted levels of each column, in one pass. Nulls are no level; too many levels is an error."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("level")) for c in columns])
    rows = (
        df.select(F.inline(pairs)).filter(F.col("level").isNotNull()).distinct()
        .limit(MAX_LEVELS * len(columns) + 1).collect()
    )
    levels: dict[str, list[str]] = {c: sorted(r["level"] for r in rows if r["column"] == c) for c in columns}
    wide = [c for c, found in levels.items() if len(found) > MAX_LEVELS]
    if wide or len(rows) > MAX_LEVELS * len(columns):
        raise ValueError(f"more than {MAX_LEVELS} levels in {wide or list(columns)}")
    return levels


def fit_level_sums(
    df: DataFrame, columns: Sequence[str], value: str, only: Column | None = None
) -> dict[str, dict[str, tuple[int, int, float]]]:
    """Per column and level: rows, rows where ``only`` holds, and the sum of ``value`` over those; one pass.

    Gives at once what level lists, most frequent values and group statistics
    need. Nulls are no level; too many levels is an error.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("level")) for c in columns])
    counted = F.lit(True) if only is None else only
    rows = (
        df.select(F.col(value).alias("_v"), counted.alias("_only"), F.inline(pairs))
        .filter(F.col("level").isNotNull())
        .groupBy("column", "level")
        .agg(
            F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("_only") & F.col("_v").isNotNull(), 1)).alias("m"),
            F.coalesce(F.sum(F.when(F.col("_only"), F.col("_v"))), F.lit(0.0)).alias("total"),
        )
        .limit(MAX_LEVELS * len(columns) + 1)
        .collect()
    )
    found = {c: {r["level"]: (r["n"], r["m"], r["total"]) for r in rows if r["column"] == c} for c in columns}
    if any(len(levels) > MAX_LEVELS for levels in found.values()) or len(rows) > MAX_LEVELS * len(columns):
        raise ValueError(f"more than {MAX_LEVELS} levels in one of {list(columns)}")
    return found


def level_values(column: str, values: dict[str, float]) -> Column:
    """The value of the row's level, from a fitted table of levels; null for a level it lacks."""
    if not values:
        return F.lit(None).cast("double")
    return F.create_map(*[x for level, v in values.items() for x in (F.lit(level), F.lit(float(v)))])[F.col(column)]


def dummies(df: DataFrame, levels: dict[str, list[str]], prefixes: dict[str, str], drop_first: bool = True) -> DataFrame:
    """0/1 columns ``prefix_level`` for fitted levels; the first level is left out by default."""
    added: dict[str, Column] = {}
    for column, found in levels.items():
        for level in found[1:] if drop_first else found:
            added[f"{prefixes.get(column, column)}_{level}"] = F.coalesce((F.col(column) == level).cast("int"), F.lit(0))
    return df.withColumns(added)


def label_pipeline(columns: Sequence[str], invalid: str = "error") -> list:
    """Integer codes ``<column>_code`` in sorted order of the levels."""
    return [
        StringIndexer(
            inputCols=list(columns), outputCols=[f"{c}_code" for c in columns],
            stringOrderType="alphabetAsc", handleInvalid=invalid,
        )
    ]


def one_hot_pipeline(columns: Sequence[str]) -> list:
    """Sparse one-hot vectors ``<column>_hot`` with all levels kept; an unseen level raises."""
    return [
        *label_pipeline(columns),
        OneHotEncoder(
            inputCols=[f"{c}_code" for c in columns], outputCols=[f"{c}_hot" for c in columns],
            dropLast=False, handleInvalid="error",
        ),
    ]


def feature_pipeline(numbers: Sequence[str], categories: Sequence[str]) -> Pipeline:
    """One-hot categories and numeric columns assembled into ``features`` in a recorded order."""
    stages = one_hot_pipeline(categories) if categories else []
    inputs = [*numbers, *[f"{c}_hot" for c in categories]]
    return Pipeline(stages=[*stages, VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="error")])


def code_labels(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Integer codes by sorted order of the levels found in ``df``."""
    fitted = Pipeline(stages=label_pipeline(columns)).fit(df)
    return fitted.transform(df).withColumns({f"{c}_code": F.col(f"{c}_code").cast("int") for c in columns})


def group_statistic(
    df: DataFrame, key: str, statistic: Column, name: str, fitted_on: DataFrame | None = None
) -> DataFrame:
    """Add an aggregate of a key's rows to each of its rows.

    ``fitted_on`` supplies the rows the aggregate is taken over (the training
    rows, say); keys it lacks get null. The aggregate has one row per key, so a
    hot key costs no more than any other.
    """
    stats = (fitted_on if fitted_on is not None else df).groupBy(key).agg(statistic.alias(name))
    return df.join(checked_broadcast(stats), key, "left")


def merged_levels(df: DataFrame, prefix: str, name: str) -> DataFrame:
    """The level named by the row's largest dummy column.

    Where the dummies leave out the first level, its rows are all zero and get
    the first remaining name, so two levels share one. Kept to reproduce frames
    made that way; encode the original column instead.
    """
    found = first_largest(columns_with_prefix(df, prefix))
    return df.withColumn(name, F.replace(found, F.lit(prefix), F.lit("")))
