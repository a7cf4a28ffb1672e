"""Train/test splits and samples that do not depend on how the data are partitioned."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tallyloom.functions.columns import row_hash
from tallyloom.operators.order_statistics import inside_first, mark_first


def hash_split(df: DataFrame, row_id: str, train_percent: int = 80, salt: str = "") -> DataFrame:
    """Add ``is_train`` by a hash of the row id: a map-side split, sizes right on average."""
    return df.withColumn("is_train", row_hash(F.col(row_id), salt) % 100 < train_percent)


def stratified_split(df: DataFrame, row_id: str, label: str, train_fraction: float = 0.75, salt: str = "") -> DataFrame:
    """Add ``is_train``: exactly ``floor(fraction * n)`` rows of every class, by row hash."""
    return mark_first(df, row_id, "is_train", fraction=train_fraction, by=label, salt=salt)


def sample_rows(df: DataFrame, row_id: str, size: int, by: str | None = None, salt: str = "") -> DataFrame:
    """Exactly ``size`` rows (per group), or all of them if there are fewer."""
    return mark_first(df, row_id, "_kept", size=size, by=by, salt=salt).filter("_kept").drop("_kept")


def chronological_split(df: DataFrame, row_id: str, day: str, train_fraction: float = 0.85) -> DataFrame:
    """Add ``is_train``: the first ``floor(fraction * n)`` rows by date.

    Rows are counted per date, and a running count over the dates finds the one
    the cut falls on. Other dates are assigned whole; inside that date the rows
    are cut at an exact number by row hash. Nothing is sorted by date.
    """
    per_day = df.groupBy(day).agg(F.count(F.lit(1)).alias("_c"))
    # One row per calendar date takes part in this window.
    running = W.orderBy(day)
    cut = (
        per_day.withColumns({"_upto": F.sum("_c").over(running), "_n": F.sum("_c").over(W.partitionBy())})
        .withColumn("_need", F.floor(F.lit(train_fraction) * F.col("_n")) - F.col("_upto") + F.col("_c"))
        .filter((F.col("_need") >= 0) & (F.col("_need") < F.col("_c")))
        .select(F.col(day).alias("cut_day"), "_need")
        .first()
    )
    if cut is None:
        return df.withColumn("is_train", F.lit(True))
    on_cut = F.col(day) == F.lit(cut["cut_day"])
    inside = inside_first(df.filter(on_cut), row_id, size=cut["_need"])
    return df.withColumn("is_train", (F.col(day) < F.lit(cut["cut_day"])) | (on_cut & inside))
