"""End-to-end analyses: each takes the star or a feature frame and returns named result frames."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Model, PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators import aggregates as agg
from tallyloom.operators import hypothesis as hyp
from tallyloom.operators import models
from tallyloom.operators.balancing import smote, smote_nc
from tallyloom.operators.boosting import Boost, Booster, accuracy_and_f1, fit_runs
from tallyloom.operators.clustering import add_clusters, assemble
from tallyloom.operators.encoding import feature_pipeline, fit_levels
from tallyloom.operators.kernels import map_for
from tallyloom.operators.metrics import accuracy_and_macro_f1, confusion_matrix, regression_table
from tallyloom.operators.models import importance_table
from tallyloom.operators.neighbours import knn_classify, nearest_neighbours
from tallyloom.operators.order_statistics import exact_quantiles
from tallyloom.operators.scaling import fit_log_minmax, fit_minmax, fit_robust, fit_standard
from tallyloom.operators.splits import hash_split, stratified_split
from tallyloom.operators.support_vectors import fit_machines, with_margins
from tallyloom.plans import frames
from tallyloom.session import stage, stage_compact
from tallyloom.sources.sinks import run_metadata, save_metadata, save_model
from tallyloom.sources.star import MEASURES, Star

DISCOUNT_LABELS = ["Discounted", "No Discount"]


# Discount test


def discount_report(star: Star) -> dict[str, DataFrame]:
    """The seven tables of the discount test."""
    groups = frames.discount_groups(star)
    counts = agg.count_by(groups, ["quantity", "discount_type"], None, "order_count")
    sizes = agg.count_by(groups, ["discount_type"], None, "order_count")
    powers = hyp.yeo_johnson_powers(groups, "quantity", "discount_type", DISCOUNT_LABELS)
    transformed = hyp.yeo_johnson_transformed(groups, "quantity", "discount_type", powers, "transformed")
    median = exact_quantiles(groups, ["quantity"], [0.5], by="discount_type")
    moments = agg.moments_by(groups, "discount_type", "quantity")
    points = [
        hyp.qq_points(transformed.filter(F.col("discount_type") == label), "transformed", label) for label in powers
    ]
    qq = points[0]
    for more in points[1:]:
        qq = qq.unionByName(more)
    return {
        "quantity_counts": counts,
        "quantity_probability": agg.share_within(counts, "discount_type", "order_count", "probability"),
        "group_size": agg.share_of_total(sizes, "order_count", "group_percent"),
        "yeo_johnson_summary": yeo_johnson_summary(transformed, powers),
        "qq_plot": qq,
        "mannwhitney_summary": mannwhitney_summary(groups),
        "group_moments": moments.join(
            median.select("discount_type", F.col("value").alias("median")), "discount_type"
        ).select("discount_type", "mean", "median", "std_dev"),
    }


def yeo_johnson_summary(transformed: DataFrame, powers: dict[str, float]) -> DataFrame:
    """Exponent, Shapiro-Wilk statistic and p-value per group, on transformed values."""
    tested = hyp.shapiro_wilk(transformed, "transformed", "discount_type")
    entries = [x for g, p in powers.items() for x in (F.lit(g), F.lit(p))]
    return tested.select(
        "discount_type", F.create_map(*entries)[F.col("discount_type")].alias("yeojohnson_lambda"),
        "shapiro_statistic", "shapiro_p_value",
    )


def mannwhitney_summary(groups: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Test name, statistic, p-value and decision."""
    test = hyp.mann_whitney(groups, "quantity", "discount_type", *DISCOUNT_LABELS)
    return test.select(
        F.lit("Mann-Whitney U").alias("test"), F.col("u_statistic").alias("statistic"), "p_value",
        (F.col("p_value") < alpha).alias("reject_h0"),
    )


# Returned orders


@dataclass
class OrderFeatures:
    """Fitted preparation of the order frame: scalers and encoder from the training rows."""

    log_amounts: object
    shares: object
    profit: object
    encoder: PipelineModel

    def transform(self, df: DataFrame) -> DataFrame:
        scaled = self.profit.transform(self.shares.transform(self.log_amounts.transform(df)))
        return self.encoder.transform(scaled).select("row_id", "is_returned", "features")


#: Added to sales and shipping cost before the logarithm, which a cost of 0 has none of; so every row gets a score.
LOG_SHIFT = 1.0


def fit_order_features(train: DataFrame) -> OrderFeatures:
    """Log and min-max for the amounts, min-max for three numbers, standard for profit, one-hot for the categories."""
    categories = frames.ORDER_CATEGORIES
    text = train.withColumns({c: F.col(c).cast("string") for c in categories})
    return OrderFeatures(
        fit_log_minmax(train, frames.LOGGED, LOG_SHIFT),
        fit_minmax(train, ["quantity", "discount", "time_difference"]),
        fit_standard(train, ["profit"]),
        feature_pipeline(frames.ORDER_NUMBERS, categories).fit(text.select(*frames.ORDER_NUMBERS, *categories)),
    )


def split_orders(star: Star) -> tuple[DataFrame, DataFrame]:
    """Training and test rows of the order frame, 80 to 20, both staged."""
    orders = stage_compact(hash_split(frames.order_features(star), "row_id", 80))
    return orders.filter("is_train").drop("is_train"), orders.filter("NOT is_train").drop("is_train")


def prepared_orders(star: Star) -> tuple[DataFrame, DataFrame]:
    """Training and test rows as vectors, prepared by what was fitted on the training rows."""
    train, test = split_orders(star)
    prepare = fit_order_features(train)
    # The arrays are made where they are read; the written vectors hold only what is not 0.
    return tuple(stage_compact(prepare.transform(part)).withColumn("x", vector_to_array("features")) for part in (train, test))


def balanced_vectors(train: DataFrame) -> DataFrame:
    """Training vectors with the smaller class raised to the size of the larger."""
    made = smote(train, "row_id", "is_returned", "x")
    return made.select("row_id", "is_returned", array_to_vector("x").alias("features"), "x")


def returned_classifier(star: Star, trees: int = 10, depth: int = 15) -> tuple[Model, DataFrame, DataFrame]:
    """Random forest on balanced training rows: (model, training vectors, scored test rows)."""
    train, test = prepared_orders(star)
    model = models.fit_on(balanced_vectors(train), models.random_forest("is_returned", trees, depth), ["is_returned", "features"])
    scored = model.transform(test).select(
        "row_id", F.col("is_returned").alias("true_label"), F.col("prediction").cast("int").alias("predicted_label")
    )
    return model, train, scored


def grid_scores(
    star: Star, folds: int = 5, trees: Sequence[int] = (1, 5, 10), neighbours: Sequence[int] = (3, 5, 9),
    penalties: Sequence[float] = (1.0, 10.0), families: Sequence[str] = ("random_forest", "knn", "logistic_regression"),
    depth: int = 10, svc_penalties: Sequence[float] = (1.0, 10.0, 20.0), kernels: Sequence[str] = ("rbf", "linear"),
    seed: int = 42,
) -> DataFrame:
    """Cross-validated scores per family and parameter. Each fold balances its own training rows.

    The family ``svm`` is linear with the plain hinge; ``kernel_svm`` has every penalty with every
    kernel and the squared hinge, all penalties in one fit. Kernels other than the linear one are estimated by maps.
    """
    train, _ = prepared_orders(star)
    folded = stage(models.with_folds(train.drop("x"), "row_id", folds)).withColumn("x", vector_to_array("features"))
    rows = []
    for fold in range(folds):
        held = folded.filter(F.col("fold") == fold).drop("fold")
        made = smote(folded.filter(F.col("fold") != fold), "row_id", "is_returned", "x")
        part = stage(made.select("row_id", "is_returned", "x")).withColumn("features", array_to_vector("x"))
        n = part.count()
        learners = {}
        if "random_forest" in families:
            learners |= {f"random_forest|n_estimators={t}": models.random_forest("is_returned", t, depth) for t in trees}
        if "logistic_regression" in families:
            learners |= {f"logistic_regression|C={c:g}": models.logistic_regression("is_returned", c, n) for c in penalties}
        if "svm" in families:
            learners |= {f"svm|C={c:g}": models.linear_svc("is_returned", c, n) for c in svc_penalties}
        for name, learner in learners.items():
            scored = learner.fit(part).transform(held).withColumn("prediction", F.col("prediction").cast("int"))
            rows.append(_score(name, fold, scored))
        if "kernel_svm" in families:
            for kernel in kernels:
                kernel_map = None if kernel == "linear" else map_for(kernel, len(part.first()["x"]), seed)
                machines = fit_machines(part, "x", "is_returned", svc_penalties, kernel_map)
                margins = stage(with_margins(held, "x", machines).select("is_returned", "margins"))
                for i, c in enumerate(svc_penalties):
                    scored = margins.withColumn("prediction", (F.col("margins")[i] > 0).cast("int"))
                    rows.append(_score(f"svm|C={c:g},kernel={kernel}", fold, scored))
        if "knn" in families:
            # One join for the largest k; the smaller ones vote on its first neighbours.
            near = stage(nearest_neighbours(held, part, max(neighbours), "row_id", "x"))
            labels = part.select(F.col("row_id").alias("neighbour_id"), F.col("is_returned").alias("vote"))
            voted = stage(near.join(labels, "neighbour_id").select("row_id", "rank", "vote"))
            for k in neighbours:
                votes = voted.filter(F.col("rank") <= k).groupBy("row_id").agg(F.mode("vote", True).alias("prediction"))
                rows.append(_score(f"knn|n_neighbors={k}", fold, held.join(votes, "row_id")))
    scores = train.sparkSession.createDataFrame(rows, "candidate string, fold int, accuracy double, f1_macro double")
    return scores.groupBy("candidate").agg(F.avg("accuracy").alias("accuracy"), F.avg("f1_macro").alias("f1_macro"))


def _score(name: str, fold: int, scored: DataFrame) -> tuple:
    row = accuracy_and_macro_f1(scored, "is_returned", "prediction", ["0", "1"]).first()
    return name, fold, row["accuracy"], row["f1_macro"]


def knn_returned(star: Star, k: int = 5) -> DataFrame:
    """Nearest-neighbour predictions for the test rows."""
    train, test = prepared_orders(star)
    found = knn_classify(test, train, k, "row_id", "x", "is_returned")
    return test.select("row_id", F.col("is_returned").alias("true_label")).join(
        found.withColumnRenamed("prediction", "predicted_label"), "row_id"
    )


# Profit


def profit_features(frame: DataFrame) -> list[str]:
    """Feature columns of a profit frame: everything but the target and the bookkeeping."""
    return [c for c in frame.columns if c not in ("profit", "row_id", "order_date_key", "is_train", "is_validation", "shipping_cost")]


def profit_model(
    star: Star, rounds: int = 687, depth: int = 2, rate: float = 0.04, subsample: float = 0.8, columns: float = 0.7,
) -> dict[str, DataFrame]:
    """Boosted regression of profit on a chronological split: metrics, importances, every row scored.

    The sub-category means are those of the training rows.
    """
    frame = stage(frames.regression_frame(star, train_fraction=0.85))
    run = Boost(rounds, depth, rate, subsample, columns, l1=0.05, l2=0.5, least_weight=2, seed=440)
    return _fitted_profit(frame, run)


def profit_model_early_stop(star: Star, rounds: int = 1000, depth: int = 4, rate: float = 0.05, patience: int = 50) -> dict[str, DataFrame]:
    """The earlier profit model on a random split.

    Boosting stops after ``patience`` rounds without a better fit of a validation part of the training
    rows, and keeps the rounds up to the best; ``rounds`` tells how many there were.
    """
    frame = frames.regression_frame_thresholds(star, train_percent=75)
    held = F.col("is_train") & (frames.row_hash_percent("validation") >= 80)
    frame = stage(frame.withColumn("is_validation", held))
    run = Boost(rounds, depth, rate, 0.8, 0.8, l1=0.1, l2=0.5, least_weight=2, seed=44, held=1, patience=patience)
    return _fitted_profit(frame, run, F.col("is_validation"))


def _fitted_profit(frame: DataFrame, run: Boost, part: Column | None = None) -> dict[str, DataFrame]:
    # Trees split at ranks of the values, so that scaling the columns would change nothing.
    features = profit_features(frame)
    model = fit_runs(frame.filter("is_train"), "row_id", features, "profit", [run], part=part)[0]
    scored = stage(model.scored(frame, ["row_id", "profit", "is_train"], "predicted_profit"))
    return {
        "predictions": scored.select("row_id", "profit", "predicted_profit", "is_train"),
        "metrics": regression_table(scored, "profit", "predicted_profit", "is_train"),
        "importances": importance_table(frame, features, model.importances()),
        "rounds": rounds_table(frame, model),
    }


def rounds_table(df: DataFrame, model: Booster) -> DataFrame:
    """``metric, value``: the rounds run and the best one, up to which trees are kept."""
    rows = [("rounds_run", float(model.rounds_run)), ("best_round", float(model.best_round))]
    return df.sparkSession.createDataFrame(rows, "metric string, value double")


def profit_grid(
    star: Star, depths: Sequence[int] = (2, 3, 4, 5), rates: Sequence[float] = (0.04, 0.05), rounds: int = 687,
    folds: int = 3,
) -> DataFrame:
    """Cross-validated R2 of the boosted regressor over a parameter grid, on the training rows; all runs in one pass."""
    frame = stage(models.with_folds(frames.regression_frame(star, train_fraction=0.85).filter("is_train"), "row_id", folds))
    features = [c for c in profit_features(frame) if c != "fold"]
    points = [(depth, rate) for depth in depths for rate in rates]
    runs = [
        Boost(rounds, depth, rate, 0.8, 0.7, l1=0.05, l2=0.5, least_weight=2, seed=440, held=fold) for depth, rate in points for fold in range(folds)
    ]
    fitted = fit_runs(frame, "row_id", features, "profit", runs, part=F.col("fold"))
    scores = [model.score(model.sums[-1]) for model in fitted]
    rows = [(d, float(r), sum(scores[i * folds : (i + 1) * folds]) / folds) for i, (d, r) in enumerate(points)]
    return star.lines.sparkSession.createDataFrame(rows, "max_depth int, learning_rate double, r2 double")


# Ship mode


def ship_mode_model(
    star: Star, rounds: int = 1000, depth: int = 2, rate: float = 0.06, folder: str | None = None,
    balance: bool = False, patience: int = 200,
) -> dict[str, DataFrame]:
    """Boosted classification of the ship mode on a stratified split.

    Returns train and test scores and confusion matrices, predictions,
    importances, the numbers of rounds and the metadata row; with ``folder`` also saves the
    category codes, the trees (JSON) and the metadata there. Boosting stops after ``patience``
    rounds without a better macro F1 of a validation part of the training rows, and keeps the rounds up to the best. ``balance`` raises the smaller classes of the training rows
    with synthetic rows, which are fitted on but not scored.
    """
    numbers, categories, label = frames.SHIP_MODE_NUMBERS, frames.SHIP_MODE_CATEGORIES, "ship_mode_name"
    frame = frames.ship_mode_frame(star).withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("none")) for c in categories})
    frame = stage(stratified_split(frame, "row_id", label, 0.75))
    classes = fit_levels(frame, [label])[label]
    train = frame.filter("is_train")
    scaling = fit_robust(train, numbers)
    scaled = scaling.transform(frame)
    train = scaled.filter("is_train").select("row_id", label, *numbers, *categories)
    if balance:
        train = smote_nc(train, "row_id", label, numbers, categories, fit_levels(train, categories))
    # Boosting stops on a part of the training rows, never on the test rows.
    train = stage(train.withColumn("is_validation", frames.row_hash_percent("validation") >= 80))
    codes = models.category_codes(categories).fit(train)
    features = [*numbers, *[f"{c}_code" for c in categories]]
    run = Boost(rounds, depth, rate, l2=3.0, held=1, patience=patience)
    model = fit_runs(
        codes.transform(train).withColumn("_class", class_number(label, classes)), "row_id", features, "_class", [run], len(classes),
        F.col("is_validation"),
    )[0]
    scored = model.scored(codes.transform(scaled), ["row_id", "is_train", label], "_class")
    scored = stage(scored.withColumn(f"predicted_{label}", class_name("_class", classes)).drop("_class"))
    parts = {"train": scored.filter("is_train"), "test": scored.filter("NOT is_train")}
    predicted = f"predicted_{label}"
    scores = {part: accuracy_and_macro_f1(df, label, predicted, classes) for part, df in parts.items()}
    matrices = {part: confusion_matrix(df, label, predicted, classes) for part, df in parts.items()}
    # Both are bounded by the number of classes.
    metrics = {part: df.first().asDict() for part, df in scores.items()}
    cells = {
        part: [[r[f"predicted_{c}"] for c in classes] for r in sorted(df.collect(), key=lambda r: r["label"])]
        for part, df in matrices.items()
    }
    metadata = run_metadata(star.lines.sparkSession, [*numbers, *categories], categories, classes, metrics, cells)
    if folder:
        save_model(codes, f"{folder}/model")
        save_metadata(model.described(star.lines.sparkSession), f"{folder}/trees")
        save_metadata(metadata, f"{folder}/metadata")
    return {
        "predictions": scored, "scores_train": scores["train"], "scores_test": scores["test"],
        "confusion_train": matrices["train"], "confusion_test": matrices["test"], "metadata": metadata,
        "importances": importance_table(scored, [*numbers, *categories], model.importances()), "rounds": rounds_table(scored, model),
    }


def class_number(column: str, classes: Sequence[str]) -> Column:
    """The place of a class in a bounded list."""
    return F.array_position(F.array(*[F.lit(c) for c in classes]), F.col(column)) - 1


def class_name(column: str, classes: Sequence[str]) -> Column:
    return F.get(F.array(*[F.lit(c) for c in classes]), F.col(column).cast("int"))


def ship_mode_rounds(star: Star, rounds: Sequence[int] = (500, 1000, 1900), folds: int = 3, depth: int = 7) -> DataFrame:
    """Cross-validated accuracy and macro F1 per number of boosting rounds, folds drawn within each ship mode.

    Each fold is fitted once, with the most rounds; the others are read off on the way.
    """
    numbers, categories, label = frames.SHIP_MODE_NUMBERS, frames.SHIP_MODE_CATEGORIES, "ship_mode_name"
    frame = frames.ship_mode_frame(star).withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("none")) for c in categories})
    frame = stage(models.with_folds(frame, "row_id", folds, by=label))
    classes = fit_levels(frame, [label])[label]
    coded = models.category_codes(categories).fit(frame).transform(frame).withColumn("_class", class_number(label, classes))
    runs = [Boost(max(rounds), depth, 0.04, l2=3.0, held=fold) for fold in range(folds)]
    fitted = fit_runs(coded, "row_id", [*numbers, *[f"{c}_code" for c in categories]], "_class", runs, len(classes), F.col("fold"))
    rows = []
    for n in rounds:
        scores = [accuracy_and_f1(model.sums[n - 1].reshape(len(classes), -1)) for model in fitted]
        rows.append((f"rounds={n}", sum(s[0] for s in scores) / folds, sum(s[1] for s in scores) / folds))
    return frame.sparkSession.createDataFrame(rows, "candidate string, accuracy double, f1_macro double")


# Customers


def segmented_customers(star: Star, years: Sequence[int]) -> DataFrame:
    """Customer features with the raw and the standardised clustering."""
    features = frames.staged_customer_features(star, years)
    columns = [*MEASURES, *[f"year_{y}" for y in years]]
    return add_clusters(features, columns)


def cluster_profile(star: Star, years: Sequence[int], k: int = 3) -> DataFrame:
    """Size, means, minima and maxima of the features per cluster."""
    clustered = segmented_customers(star, years)
    columns = [*MEASURES, *[f"year_{y}" for y in years]]
    name = "cluster_k3_raw" if k == 3 else "cluster_k5_scaled"
    return agg.profile_by(clustered, name, columns)
