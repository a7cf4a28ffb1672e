"""Scores of predictions: regression, confusion, classification report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: n, r2, mse, rmse, mae. One pass over the rows.

    The total sum of squares comes from the population variance, which Spark
    merges without cancellation.
    """
    y, error = F.col(label), F.col(label) - F.col(prediction)
    sums = df.agg(
        F.count(F.lit(1)).alias("n"), F.avg(error * error).alias("mse"), F.avg(F.abs(error)).alias("mae"),
        F.var_pop(y).alias("variance"),
    )
    return sums.select(
        "n", (F.lit(1.0) - F.try_divide("mse", "variance")).alias("r2"), "mse", F.sqrt("mse").alias("rmse"), "mae"
    )


def regression_table(scored: DataFrame, label: str, prediction: str, train_flag: str) -> DataFrame:
    """Rows (metric, value): R2 on train and test, their gap in points, and MSE, RMSE, MAE on test."""
    y, error, train = F.col(label), F.col(label) - F.col(prediction), F.col(train_flag)
    pick = lambda f, x, part: f(F.when(train if part else ~train, x))
    sums = scored.agg(
        pick(F.avg, error * error, True).alias("mse_train"), pick(F.avg, error * error, False).alias("mse_test"),
        pick(F.var_pop, y, True).alias("var_train"), pick(F.var_pop, y, False).alias("var_test"),
        pick(F.avg, F.abs(error), False).alias("mae_test"),
    )
    r2 = lambda part: F.lit(1.0) - F.try_divide(f"mse_{part}", f"var_{part}")
    values = {
        "r2_train": r2("train"), "r2_test": r2("test"),
        "r2_gap_points": F.round((r2("train") - r2("test")) * 100, 2),
        "mse_test": F.col("mse_test"), "rmse_test": F.sqrt("mse_test"), "mae_test": F.col("mae_test"),
    }
    pairs = [F.struct(F.lit(k).alias("metric"), v.alias("value")) for k, v in values.items()]
    return sums.select(F.inline(F.array(*pairs)))


def outcome_counts(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Rows per (label, prediction): at most the square of the number of classes."""
    return df.groupBy(F.col(label).cast("string").alias("y"), F.col(prediction).cast("string").alias("p")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _label_rows(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    one = df.sparkSession.range(1)
    return one.select(F.explode(F.array(*[F.lit(str(v)) for v in labels])).alias("label"))


def confusion_matrix(df: DataFrame, label: str, prediction: str, labels: Sequence[str]) -> DataFrame:
    """One row per class in a fixed order, one column ``predicted_<class>`` per class; 0 where nothing fell."""
    counts = outcome_counts(df, label, prediction)
    columns = [F.coalesce(F.sum(F.when(F.col("p") == str(v), F.col("n"))), F.lit(0)).cast("bigint").alias(f"predicted_{v}") for v in labels]
    rows = _label_rows(df, labels)
    return rows.join(counts, rows.label == counts.y, "left").groupBy("label").agg(*columns)


def classification_report(df: DataFrame, label: str, prediction: str, labels: Sequence[str]) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted averages.

    A ratio without a denominator is 0, as is the F1 of a class never predicted.
    """
    counts = outcome_counts(df, label, prediction)
    # Each cell counts once for its true and once for its predicted class.
    zero = F.lit(0).cast("bigint")
    hit = F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(zero)
    sides = F.array(
        F.struct(F.col("y").alias("label"), hit.alias("tp"), F.col("n").alias("support"), zero.alias("predicted")),
        F.struct(F.col("p").alias("label"), zero.alias("tp"), zero.alias("support"), F.col("n").alias("predicted")),
    )
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("double").alias(c)
    per_class = (
        _label_rows(df, labels)
        .join(counts.select(F.inline(sides)), "label", "left")
        .groupBy("label")
        .agg(total("tp"), total("support"), total("predicted"))
    )
    rate = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    scored = per_class.select(
        "label", rate(F.col("tp"), F.col("predicted")).alias("precision"), rate(F.col("tp"), F.col("support")).alias("recall"),
        rate(2 * F.col("tp"), F.col("predicted") + F.col("support")).alias("f1"), "support", "tp",
    )
    measures = ["precision", "recall", "f1"]
    n = F.sum("support")
    summary = scored.agg(
        n.alias("n"), rate(F.sum("tp"), n).alias("accuracy"),
        *[F.avg(m).alias(f"macro_{m}") for m in measures],
        *[rate(F.sum(F.col(m) * F.col("support")), n).alias(f"weighted_{m}") for m in measures],
    )
    line = lambda name, values: F.struct(
        F.lit(name).alias("label"), *[v.alias(m) for m, v in zip(measures, values)], F.col("n").alias("support")
    )
    averages = summary.select(
        F.inline(
            F.array(
                line("accuracy", [F.col("accuracy")] * 3),
                line("macro avg", [F.col(f"macro_{m}") for m in measures]),
                line("weighted avg", [F.col(f"weighted_{m}") for m in measures]),
            )
        )
    )
    return scored.select("label", *measures, "support").unionByName(averages)


def accuracy_and_macro_f1(df: DataFrame, label: str, prediction: str, labels: Sequence[str]) -> DataFrame:
    """One row: accuracy and the unweighted mean of the classes' F1."""
    report = classification_report(df, label, prediction, labels)
    value = lambda name, m: F.max(F.when(F.col("label") == name, F.col(m)))
    return report.agg(value("accuracy", "f1").alias("accuracy"), value("macro avg", "f1").alias("f1_macro"))
