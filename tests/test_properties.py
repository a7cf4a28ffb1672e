"""Properties that hold whatever the data, and models within tolerances."""

import dataclasses
import math
import random
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tallyloom.functions.columns import yeo_johnson
from tallyloom.functions.normal import normal_quantile
from tallyloom.operators import clustering, hypothesis, models, splits
from tallyloom.operators import neighbours as near
from tallyloom.operators.order_statistics import exact_quantiles
from tallyloom.functions.columns import unit_hash
from tallyloom.operators.balancing import smote, smote_nc
from tallyloom.plans import frames, jobs, queries
from tallyloom.sources import sinks
from tallyloom.sources.star import (
    CSV_SCHEMAS, denormalise, fact_sales, load_star, register_views, star_from_csv, star_from_views,
)
from conftest import MIDDLE

YEARS = list(range(1995, 2002))


def test_shares_sum_to_one(spark, star):
    report = jobs.discount_report(star)
    assert set(report) == {
        "quantity_counts", "quantity_probability", "group_size", "yeo_johnson_summary", "qq_plot",
        "mannwhitney_summary", "group_moments",
    }
    sums = report["quantity_probability"].groupBy("discount_type").agg(F.sum("probability").alias("s")).collect()
    assert all(r["s"] == pytest.approx(1.0) for r in sums) and len(sums) == 2
    assert report["qq_plot"].count() == frames.discount_groups(star).count()
    row = report["mannwhitney_summary"].first()
    assert 0 <= row["p_value"] <= 1 and row["reject_h0"] == (row["p_value"] < 0.05)
    names = sinks.publish(report)
    assert spark.table(names[0]).count() == report[names[0]].count()


def test_splits_do_not_depend_on_partitions(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("row_id"), (F.col("id") % 3).alias("c"))

    def train(frame):
        return {r["row_id"] for r in splits.stratified_split(frame, "row_id", "c", 0.75).filter("is_train").collect()}

    first = train(df)
    assert first == train(df.repartition(11))
    sizes = df.groupBy("c").count().collect()
    kept = splits.stratified_split(df, "row_id", "c", 0.75).filter("is_train").groupBy("c").count().collect()
    assert {r["c"]: r["count"] for r in kept} == {r["c"]: int(r["count"] * 0.75) for r in sizes}
    assert splits.sample_rows(df, "row_id", 100).count() == 100
    assert splits.sample_rows(df, "row_id", 10_000).count() == 5000
    assert splits.sample_rows(df, "row_id", 100, by="c").count() == 300


def test_u_statistics_add_up(spark):
    random.seed(3)
    a, b = [random.randint(0, 9) for _ in range(200)], [random.randint(1, 9) for _ in range(150)]
    df = spark.createDataFrame([("a", float(x)) for x in a] + [("b", float(x)) for x in b], "g string, x double")
    one = hypothesis.mann_whitney(df, "x", "g", "a", "b").first()
    two = hypothesis.mann_whitney(df, "x", "g", "b", "a").first()
    assert one["u_statistic"] + two["u_statistic"] == 200 * 150
    assert one["u_statistic"] == sum((x > y) + 0.5 * (x == y) for x in a for y in b)
    assert one["p_value"] == pytest.approx(two["p_value"])


def test_normal_quantile(spark):
    ps = [1e-12, 1e-6, 0.001, 0.07, 0.075, 0.3, 0.5, 0.62, 0.95, 0.999999]
    got = spark.createDataFrame([(p,) for p in ps], "p double").select(normal_quantile(F.col("p")).alias("z")).collect()
    assert [r["z"] for r in got] == pytest.approx([NormalDist().inv_cdf(p) for p in ps], abs=1e-12)


def test_shapiro_known_values():
    weights = np.array([148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236], dtype=float)
    w, p = hypothesis.shapiro_statistic(weights)
    assert w == pytest.approx(0.78881, abs=2e-4) and p == pytest.approx(0.0067, abs=3e-4)
    rng = np.random.default_rng(1)
    rejected = sum(hypothesis.shapiro_statistic(rng.normal(size=50))[1] < 0.05 for _ in range(400))
    assert 6 <= rejected <= 40
    assert hypothesis.shapiro_statistic(rng.exponential(size=200))[1] < 1e-6


def test_yeo_johnson_maximises_the_likelihood(spark):
    rng = np.random.default_rng(5)
    groups = {"a": rng.lognormal(size=700) - 0.5, "b": rng.normal(3, 1, size=500) ** 2}
    rows = [(g, float(x)) for g, xs in groups.items() for x in xs]
    found = hypothesis.yeo_johnson_powers(spark.createDataFrame(rows, "g string, x double"), "x", "g", ["a", "b"])

    def likelihood(x, p):
        positive = (np.power(np.maximum(x, 0) + 1, p) - 1) / p
        negative = -(np.power(1 - np.minimum(x, 0), 2 - p) - 1) / (2 - p)
        y = np.where(x >= 0, positive, negative)
        return -len(x) / 2 * math.log(y.var()) + (p - 1) * (np.sign(x) * np.log1p(abs(x))).sum()

    for g, x in groups.items():
        grid = np.arange(found[g] - 0.5, found[g] + 0.5, 0.00103)
        assert likelihood(x, found[g]) >= max(likelihood(x, p) for p in grid) - 1e-7


def test_yeo_johnson_limits(spark):
    row = spark.range(1).select(
        yeo_johnson(F.lit(3.0), F.lit(0.0)).alias("zero"), yeo_johnson(F.lit(-3.0), F.lit(2.0)).alias("two"),
        yeo_johnson(F.lit(3.0), F.lit(1.0)).alias("same"), yeo_johnson(F.lit(-3.0), F.lit(1.0)).alias("same_negative"),
    ).first()
    assert row["zero"] == pytest.approx(math.log(4)) and row["two"] == pytest.approx(-math.log(4))
    assert row["same"] == pytest.approx(3.0) and row["same_negative"] == pytest.approx(-3.0)


def brute_force(queries, candidates, k, skip_self):
    found = {}
    for q, x in queries.items():
        ranked = sorted((math.dist(x, y), c) for c, y in candidates.items() if not (skip_self and c == q))
        found[q] = [c for _, c in ranked[:k]]
    return found


@pytest.mark.parametrize("dimensions,n,copies", [(2, 300, 0), (6, 400, 130)])
def test_neighbours_equal_brute_force(spark, dimensions, n, copies):
    rng = np.random.default_rng(dimensions)
    x = rng.normal(size=(n, dimensions))
    x[:copies] = x[0]
    points = {f"p{i:04d}": x[i].tolist() for i in range(n)}
    df = spark.createDataFrame(list(points.items()), "id string, v array<double>")

    def lists(result):
        out = {}
        for r in sorted(result.collect(), key=lambda r: r["rank"]):
            out.setdefault(r["id"], []).append(r["neighbour_id"])
        return out

    assert lists(near.nearest_neighbours(df, df, 5, "id", "v", exclude_self=True)) == brute_force(points, points, 5, True)
    asked = {f"q{i}": rng.normal(size=dimensions).tolist() for i in range(60)}
    queries = spark.createDataFrame(list(asked.items()), "id string, v array<double>")
    assert lists(near.nearest_neighbours(queries, df, 3, "id", "v")) == brute_force(asked, points, 3, False)


def test_quick_distances_lose_no_neighbour(spark):
    """Far more candidates than a group, values far from 0, equal and unusable ones: exactly the nearest, without a look at all pairs."""
    rng = np.random.default_rng(8)
    points = np.hstack([rng.normal(size=(3000, 3)) * [1, 100, 1e-3] + [1e4, -7, 3], rng.integers(0, 2, (3000, 5))])
    points[:40] = points[0]
    points[50, 1] = np.nan
    known = near.Candidates(points)
    asked = np.vstack([points[:30], points[100:130] + 1e-4, [[1e4, 1e30, 0, 0, 0, 0, 0, 0]]])
    rows, columns = known.near(asked, 6)
    exact = known.distances(asked, rows, columns)
    whole = np.sqrt(((asked[:, None] - points[None]) ** 2).sum(axis=2))
    for i in range(len(asked)):
        mine = sorted(zip(exact[rows == i], columns[rows == i]))[:6]
        true = sorted((d, j) for j, d in enumerate(whole[i]) if d == d)[:6]
        assert mine == [(pytest.approx(d, rel=1e-12), j) for d, j in true]
    assert len(rows) < 61 * 300 + 3000


def test_candidates_are_those_of_the_least_hashes(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("id"), F.array(F.col("id").cast("double")).alias("v"))
    ordered = [r["id"] for r in df.orderBy(unit_hash(F.col("id"), "candidate"), "id").collect()]
    for most in (1, 700, 5000, 9000):
        assert sorted(r["id"] for r in near.bounded_candidates(df, "id", "v", most).collect()) == sorted(ordered[:most])


def test_neighbours_with_few_candidates(spark):
    df = spark.createDataFrame([("a", [0.0]), ("b", [1.0])], "id string, v array<double>")
    got = near.nearest_neighbours(df, df, 5, "id", "v", exclude_self=True).collect()
    assert {(r["id"], r["neighbour_id"]) for r in got} == {("a", "b"), ("b", "a")}


def test_smote_balances_and_interpolates(spark):
    rng = np.random.default_rng(2)
    rows = [(f"m{i}", 0, rng.normal(size=3).tolist()) for i in range(20)] + [(f"s{i}", 1, rng.normal(size=3).tolist()) for i in range(5)]
    df = spark.createDataFrame(rows, "row_id string, y int, v array<double>")
    made = smote(df, "row_id", "y", "v", k=3)
    got = made.collect()
    synthetic = [r for r in got if r["is_synthetic"]]
    assert len(synthetic) == 15 and all(r["y"] == 1 for r in synthetic) and len(got) == 40
    small = [np.array(v) for i, y, v in rows if y == 1]
    for r in synthetic:
        p = np.array(r["v"])
        gaps = [np.linalg.norm(p - a) + np.linalg.norm(p - b) - np.linalg.norm(a - b) for a in small for b in small]
        assert min(gaps) < 1e-9
    again = smote(df.repartition(5), "row_id", "y", "v", k=3).collect()
    assert sorted((r["row_id"], tuple(r["v"])) for r in again) == sorted((r["row_id"], tuple(r["v"])) for r in got)


def test_smote_nc_takes_known_categories(spark):
    rng = np.random.default_rng(4)
    rows = [(f"m{i}", "big", float(rng.normal()), "ab"[i % 2]) for i in range(12)]
    rows += [(f"s{i}", "small", float(rng.normal()), "c") for i in range(4)]
    df = spark.createDataFrame(rows, "row_id string, y string, x double, s string")
    made = smote_nc(df, "row_id", "y", ["x"], ["s"], {"s": ["a", "b", "c"]}, k=2).filter("is_synthetic").collect()
    assert len(made) == 8 and {r["s"] for r in made} == {"c"}
    xs = [r[2] for r in rows if r[1] == "small"]
    assert all(min(xs) - 1e-12 <= r["x"] <= max(xs) + 1e-12 for r in made)


def test_shapiro_on_whole_groups(spark):
    rng = np.random.default_rng(5)
    groups = {"a": rng.normal(size=4000), "b": rng.integers(0, 9, 7000).astype(float), "c": rng.normal(size=4), "d": np.array([1.0, 2.0, 4.0]), "e": np.full(9, 2.0)}
    rows = [(g, float(v)) for g, values in groups.items() for v in values] + [("a", None)]
    found = hypothesis.shapiro_wilk(spark.createDataFrame(rows, "g string, v double"), "v", "g").collect()
    for r in found:
        w, p = hypothesis.shapiro_statistic(groups[r["g"]])
        assert r["n"] == len(groups[r["g"]]) and r["shapiro_statistic"] == pytest.approx(w, rel=1e-6) and r["shapiro_p_value"] == pytest.approx(p, rel=1e-3, abs=1e-12)
    assert len(found) == len(groups)


def test_brackets_that_miss_are_widened(spark):
    values = [float(i * i % 7919) for i in range(50_000)]
    df = spark.createDataFrame([(i % 3, v) for i, v in enumerate(values)], "g int, v double")
    exact = {p: float(np.quantile(values, p)) for p in (0.1, 0.5, 0.93)}
    narrow = exact_quantiles(df, ["v"], list(exact), accuracy=100, margin=0.0)
    assert {r["prob"]: r["value"] for r in narrow.collect()} == pytest.approx(exact)
    by_group = exact_quantiles(df, ["v"], [0.5], by="g", accuracy=100, margin=0.0).collect()
    assert {r["g"]: r["value"] for r in by_group} == pytest.approx({g: float(np.quantile(values[g::3], 0.5)) for g in range(3)})


def test_folds_have_equal_class_shares(spark):
    df = spark.range(9000).select(F.col("id").cast("string").alias("row_id"), F.when(F.col("id") % 10 == 0, "rare").otherwise("common").alias("c"))
    sizes = models.with_folds(df, "row_id", 3, by="c").groupBy("c", "fold").count().collect()
    assert {(r["c"], r["fold"]): r["count"] for r in sizes} == {("rare", f): 300 for f in range(3)} | {("common", f): 2700 for f in range(3)}


def test_a_column_of_many_levels(spark):
    rows = [(float(i % 7), f"city {i % 5000}", "x" if i % 7 > 3 else "y") for i in range(10_000)]
    df = spark.createDataFrame(rows, "n double, city string, label_name string")
    pipeline = models.coded_classifier(["n"], ["city"], "label_name", models.boosted_classifier(2, 2, 0.3), ["x", "y"])
    scored = pipeline.fit(df).transform(df.withColumn("city", F.concat("city", F.lit("!"))))
    assert scored.where("predicted_label_name = label_name").count() == len(rows)


def test_statistics_of_the_profit_frame_come_from_training_rows(spark, star):
    lines = star.lines.withColumn("test", F.expr("conv(substring(md5(row_id), 1, 8), 16, 10) % 100 >= 75"))
    changed = dataclasses.replace(star, lines=lines.withColumn("sales", F.when(F.col("test"), F.col("sales") * 9).otherwise(F.col("sales"))).drop("test"))
    train = [frames.regression_frame_thresholds(s, train_percent=75).filter("is_train").select("row_id", "is_high_value_order", "sum_sale_of_each_market") for s in (star, changed)]
    assert train[0].count() > 0 and sorted(map(tuple, train[0].collect())) == sorted(map(tuple, train[1].collect()))


def test_every_date_is_kept(spark, star):
    odd = star.lines.limit(5).withColumn("ship_date_key", F.lit(25001231).cast("bigint"))
    changed = dataclasses.replace(star, lines=odd)
    rows = denormalise(changed, ["product"], ship_dates=True).collect()
    assert len(rows) == 5 and all(r["ship_year"] == 2500 and r["ship_quarter"] == 4 for r in rows)


def test_returned_classifier_and_importances(spark, star):
    model, train, scored = jobs.returned_classifier(star, trees=3, depth=5)
    assert scored.count() > 0 and {r[0] for r in scored.select("predicted_label").distinct().collect()} <= {0, 1}
    table = models.importances(model, train).collect()
    assert sum(r["importance"] for r in table) == pytest.approx(1.0)
    assert [r["importance"] for r in table] == sorted((r["importance"] for r in table), reverse=True)
    assert {"sales", "quantity"} <= {r["feature"] for r in table}


def test_profit_model_beats_the_mean(spark, star):
    result = jobs.profit_model(star, rounds=5, rate=0.3)
    values = {r["metric"]: r["value"] for r in result["metrics"].collect()}
    assert values["r2_test"] > 0.5 and values["rmse_test"] == pytest.approx(math.sqrt(values["mse_test"]))
    assert result["predictions"].count() == star.lines.filter("is_returned = 0").count()
    assert not {"profit", "row_id", "order_date_key"} & {r["feature"] for r in result["importances"].collect()}


def test_ship_mode_model_is_saved(spark, star, tmp_path):
    results = jobs.ship_mode_model(star, rounds=1, folder=str(tmp_path))
    assert results["predictions"].count() == star.lines.count()
    for part in ("train", "test"):
        total = results["predictions"].filter("is_train" if part == "train" else "NOT is_train").count()
        matrix = results[f"confusion_{part}"].collect()
        assert sum(v for r in matrix for k, v in r.asDict().items() if k != "label") == total
    metadata = sinks.read_metadata(spark, str(tmp_path / "metadata"))
    assert metadata["target_classes"] == ["First Class", "Same Day", "Second Class", "Standard Class"]
    assert 0 <= metadata["metrics"]["test"]["f1_macro"] <= 1
    assert PipelineModel.load(str(tmp_path / "model")).stages


def test_clusters_are_repeatable(spark, star):
    features = frames.staged_customer_features(star, YEARS)
    columns = ["sales", "quantity", "discount"]
    one = clustering.add_clusters(features, columns).collect()
    assert sorted(map(str, clustering.add_clusters(features, columns).collect())) == sorted(map(str, one))
    assert {r["cluster_k3_raw"] for r in one} == {0, 1, 2}
    sweep = {r["k"]: r["wcss"] for r in clustering.choose_k(features, columns, [1, 2, 4]).collect()}
    assert sweep[1] > sweep[2] > sweep[4]


def test_components_are_centred_and_ordered(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 3)) * [5, 2, 0.1] + [100, -7, 3]
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "row_id int, a double, b double, c double")
    got = np.array([[r["pc1"], r["pc2"]] for r in clustering.principal_components(df, ["a", "b", "c"], keep=["row_id"]).orderBy("row_id").collect()])
    centred = x - x.mean(axis=0)
    _, _, basis = np.linalg.svd(centred, full_matrices=False)
    assert np.abs(got) == pytest.approx(np.abs(centred @ basis[:2].T), abs=1e-8)


def test_knn_vote(spark):
    train = spark.createDataFrame([("a", [0.0], 0), ("b", [0.1], 0), ("c", [1.0], 1), ("d", [1.1], 1), ("e", [1.2], 1)], "row_id string, v array<double>, y int")
    ask = spark.createDataFrame([("q", [0.02]), ("r", [1.05])], "row_id string, v array<double>")
    got = {r["row_id"]: r["prediction"] for r in near.knn_classify(ask, train, 3, "row_id", "v", "y").collect()}
    assert got == {"q": 0, "r": 1}


def test_star_from_csv_equals_parquet(spark, tmp_path):
    """The same star written as the CSV files and read back gives the same frames."""
    star = load_star(spark, MIDDLE)
    dims = {"Dim_Customer": star.customer, "Dim_Product": star.product, "Dim_Geography": star.geography, "Dim_Market": star.market,
            "Dim_Priority": star.priority, "Dim_Ship_Mode": star.ship_mode,
            "Dim_Date": star.date.withColumn("date", F.date_format("date", "yyyy-MM-dd HH:mm:ss.SSS"))}
    fact = fact_sales(star).withColumn("row_id", F.xxhash64("row_id"))
    for name, df in {"Fact_Sales": fact, **dims}.items():
        columns = [F.col(n.lower().replace(" ", "_")).alias(n) for n, _ in CSV_SCHEMAS[name]]
        df.select(*columns).coalesce(1).write.option("header", True).csv(str(tmp_path / f"{name}.csv"))
    back = star_from_csv(spark, str(tmp_path))
    rows = lambda s: sorted(map(str, frames.customer_features(s, YEARS).select("customer_id", "quantity", *[f"year_{y}" for y in YEARS]).collect()))
    assert rows(back) == rows(star)
    register_views(back)
    assert denormalise(star_from_views(spark), order_dates=True).count() == 60_000
    assert spark.sql("SELECT count(*) FROM fact_sales JOIN dim_market USING (market_key)").first()[0] == 60_000
    paths = sinks.save_tables({"features": frames.customer_features(back, YEARS)}, str(tmp_path / "out"))
    assert spark.read.parquet(paths[0]).count() == 1500


def test_neighbours_of_repeated_ids_stay_within_the_wanted(spark):
    """A row that comes twice leaves out both of itself among the k + 1 nearest, however near the next ones are."""
    df = spark.createDataFrame([("a", [0.0]), ("a", [0.0]), ("b", [1.0]), ("c", [1.0 + 1e-6])], "id string, v array<double>")
    got = near.nearest_neighbours(df.filter("id = 'a'").limit(1), df, 2, "id", "v", exclude_self=True).collect()
    assert [(r["neighbour_id"], r["rank"]) for r in got] == [("b", 1)]


def test_splits_read_rows_that_were_joined_once(star):
    """What the splits return reads staged rows: the lines meet their orders no second time."""
    for query in (queries.chrono_split, queries.chrono_split_validation, queries.stratified_split):
        plan = query(star)._jdf.queryExecution().optimizedPlan().toString()
        assert "Relation" not in plan and "parquet" not in plan
