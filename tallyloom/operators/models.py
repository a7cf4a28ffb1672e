"""Classifiers and regressors, model selection, importances."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (
    GBTClassifier, LinearSVC, LogisticRegression, OneVsRest, RandomForestClassifier,
)
from pyspark.ml.feature import IndexToString, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyloom.functions.columns import row_hash
from tallyloom.operators.metrics import accuracy_and_macro_f1
from tallyloom.session import ensure_checkpoint_dir, stage


def random_forest(label: str, trees: int = 10, depth: int = 15, seed: int = 42, **options) -> RandomForestClassifier:
    """A random forest; deep trees, up to the library's limit of 30."""
    return RandomForestClassifier(
        labelCol=label, featuresCol="features", numTrees=trees, maxDepth=depth, seed=seed, cacheNodeIds=True,
        checkpointInterval=10, **options,
    )


def logistic_regression(label: str, c: float, rows: int) -> LogisticRegression:
    """L2-penalised logistic regression with inverse penalty ``c`` on ``rows`` training rows."""
    return LogisticRegression(
        labelCol=label, featuresCol="features", regParam=1.0 / (c * rows), elasticNetParam=0.0, standardization=False
    )


def linear_svc(label: str, c: float, rows: int) -> LinearSVC:
    """A linear support-vector classifier with inverse penalty ``c``."""
    return LinearSVC(labelCol=label, featuresCol="features", regParam=1.0 / (c * rows), standardization=False)


def boosted_regressor(
    label: str, rounds: int = 687, depth: int = 2, rate: float = 0.04, subsample: float = 0.8, columns: float = 0.7,
    min_rows: int = 2, seed: int = 440, validation: str | None = None, tolerance: float = 0.01,
) -> GBTRegressor:
    """Gradient-boosted trees; with ``validation`` (a 0/1 column) it stops when that part no longer improves."""
    model = GBTRegressor(
        labelCol=label, featuresCol="features", maxIter=rounds, maxDepth=depth, stepSize=rate, subsamplingRate=subsample,
        featureSubsetStrategy=str(columns), minInstancesPerNode=min_rows, seed=seed, checkpointInterval=10,
        cacheNodeIds=True, validationTol=tolerance,
    )
    return model.setValidationIndicatorCol(validation) if validation else model


def boosted_classifier(
    rounds: int = 1000, depth: int = 2, rate: float = 0.06, seed: int = 42, max_bins: int = 128,
    validation: str | None = None,
) -> OneVsRest:
    """A multi-class booster: one binary booster per class. Expects ``label`` and ``features``."""
    binary = GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=rate, seed=seed, maxBins=max_bins, checkpointInterval=10)
    if validation:
        binary = binary.setValidationIndicatorCol(validation)
    return OneVsRest(classifier=binary, labelCol="label", featuresCol="features", parallelism=4)


def category_codes(categories: Sequence[str]) -> Pipeline:
    """Adds ``<category>_code``: the rank of the level by frequency; a level not seen at fit time comes after all others."""
    return Pipeline(stages=[StringIndexer(
        inputCols=list(categories), outputCols=[f"{c}_code" for c in categories], stringOrderType="frequencyDesc", handleInvalid="keep"
    )])


def coded_classifier(
    numbers: Sequence[str], categories: Sequence[str], label: str, learner: Estimator, classes: Sequence[str]
) -> Pipeline:
    """Codes, vector, learner and class names in one pipeline; the classes are in sorted order.

    A category's code is the rank of its level by frequency, a plain number, so that a
    column may have any number of levels. A level not seen at fit time comes after all
    others, so later data can be scored.
    """
    codes = StringIndexer(
        inputCols=list(categories), outputCols=[f"{c}_code" for c in categories], stringOrderType="frequencyDesc", handleInvalid="keep"
    )
    # Without the metadata of nominal columns, of which trees allow as many levels as bins.
    plain = SQLTransformer(statement="SELECT *, " + ", ".join(f"`{c}_code` + 0.0D AS `{c}_rank`" for c in categories) + " FROM __THIS__")
    return Pipeline(
        stages=[
            codes,
            plain,
            StringIndexer(inputCol=label, outputCol="label", stringOrderType="alphabetAsc"),
            VectorAssembler(inputCols=[*numbers, *[f"{c}_rank" for c in categories]], outputCol="features"),
            learner,
            IndexToString(inputCol="prediction", outputCol=f"predicted_{label}", labels=list(classes)),
        ]
    )


def fit_on(df: DataFrame, estimator: Estimator, columns: Sequence[str] | None = None) -> Model:
    """Fit on a staged copy of the needed columns, so that iterations re-read only those."""
    ensure_checkpoint_dir(df.sparkSession)
    return estimator.fit(stage(df.select(*columns) if columns else df))


def importances(model: Transformer, features: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Importances as (feature, importance, importance_percent), largest first.

    Names come from the metadata of the vector column unless given. The result
    has one row per model feature.
    """
    last = model.stages[-1] if isinstance(model, PipelineModel) else model
    values = last.featureImportances.toArray().tolist()
    if names is None:
        names = vector_names(features, "features", len(values))
    return importance_table(features, names, values)


def mean_importances(model: PipelineModel, df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Importances averaged over the binary models of a one-per-class pipeline."""
    binary = next(stage for stage in model.stages if hasattr(stage, "models")).models
    values = sum(m.featureImportances.toArray() for m in binary) / len(binary)
    return importance_table(df, names, values.tolist())


def importance_table(df: DataFrame, names: Sequence[str], values: Sequence[float]) -> DataFrame:
    """``feature, importance, importance_percent``, largest first."""
    rows = [(str(n), float(v), 100.0 * float(v)) for n, v in zip(names, values)]
    table = df.sparkSession.createDataFrame(rows, "feature string, importance double, importance_percent double")
    return table.orderBy(F.desc("importance"), "feature")


def vector_names(df: DataFrame, column: str, size: int) -> list[str]:
    """Names of a vector's slots, from the column's metadata."""
    attributes = df.schema[column].metadata.get("ml_attr", {}).get("attrs", {})
    names = {a["idx"]: a["name"] for group in attributes.values() for a in group}
    return [names.get(i, f"{column}_{i}") for i in range(size)]


def with_folds(df: DataFrame, row_id: str, folds: int, salt: str = "fold", by: str | None = None) -> DataFrame:
    """Add ``fold`` by row hash: the same on any partitioning.

    With ``by`` each of its classes has the same share in every fold, up to one row for
    each block of hashes: a class is dealt out in the order of its rows' hashes, block by block.
    """
    mark = row_hash(F.col(row_id), salt)
    if by is None:
        return df.withColumn("fold", (mark % folds).cast("int"))
    # Blocks grow in number with the rows, so that no task ranks more than a few thousand.
    blocks = max(1, df.count() // 5000)
    keyed = df.withColumns({"_mark": mark, "_block": F.xxhash64(row_id) % blocks})
    turn = F.row_number().over(Window.partitionBy(by, "_block").orderBy("_mark", row_id)) + F.abs(F.col("_block"))
    return keyed.withColumn("fold", (turn % folds).cast("int")).drop("_mark", "_block")


def cross_validate(
    df: DataFrame, folds: int, candidates: dict[str, Callable[[DataFrame, DataFrame], DataFrame]],
    label: str, classes: Sequence[str],
) -> DataFrame:
    """Mean accuracy and macro F1 over the folds per candidate: (candidate, accuracy, f1_macro).

    ``df`` has a ``fold`` column. A candidate takes the training and the held-out
    rows of a fold and returns the held-out rows with ``prediction``; whatever it
    fits, balancing included, sees the training rows only.
    """
    rows = []
    for name, candidate in candidates.items():
        for fold in range(folds):
            held, train = df.filter(F.col("fold") == fold), df.filter(F.col("fold") != fold)
            scored = candidate(train, held)
            row = accuracy_and_macro_f1(scored, label, "prediction", classes).first()
            rows.append((name, fold, row["accuracy"], row["f1_macro"]))
    scores = df.sparkSession.createDataFrame(rows, "candidate string, fold int, accuracy double, f1_macro double")
    return scores.groupBy("candidate").agg(F.avg("accuracy").alias("accuracy"), F.avg("f1_macro").alias("f1_macro"))


def best_per_family(scores: DataFrame) -> DataFrame:
    """Best candidate of each family, whose name is the part before the first ``|``."""
    family = F.substring_index("candidate", "|", 1)
    return scores.groupBy(family.alias("family")).agg(
        F.max_by("candidate", "accuracy").alias("best"), F.max("accuracy").alias("accuracy")
    )
