"""Kernel feature maps, k-means sweeps in shared passes, and the order table of a CSV source."""

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tallyloom.operators import clustering, kernels, lloyd
from tallyloom.operators.support_vectors import fit_machines, with_margins
from tallyloom.sources.star import CSV_SCHEMAS, Star, fact_sales, star_from_csv, with_order_lookup


def rows_of(spark, x, **more):
    names = list(more)
    data = [(i, [float(v) for v in r], *[more[n][i].item() for n in names]) for i, r in enumerate(x)]
    return spark.createDataFrame(data, "row_id int, x array<double>" + "".join(f", {n} double" for n in names)).repartition(4, "row_id")


@pytest.mark.parametrize("kernel", ["rbf", "poly"])
def test_maps_estimate_their_kernels(kernel):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(40, 6))
    x /= np.sqrt((x * x).sum(axis=1))[:, None] / 2
    dot = x @ x.T
    square = (x * x).sum(axis=1)
    exact = np.exp(-(square[:, None] + square[None, :] - 2 * dot) / 6) if kernel == "rbf" else (dot / 6) ** 3
    # Bounds of the variances of both estimates, of one feature; the poly kernel's is in units of its largest value squared.
    variance = 1.5 if kernel == "rbf" else 3.0**3 - 1
    for size in (256, 4096):
        z = kernels.map_for(kernel, 6, seed=3, size=size).apply(x)
        error = np.sqrt(np.mean((z @ z.T - exact) ** 2)) / exact.max()
        assert error < np.sqrt(variance / size)


def test_a_shifted_polynomial_is_estimated():
    x = np.random.default_rng(4).uniform(size=(20, 3))
    z = kernels.sketch_map(3, degree=2, gamma=1.0, shift=1.0, size=4096).apply(x)
    exact = (x @ x.T + 1) ** 2
    assert np.abs(z @ z.T - exact).max() < 0.1 * exact.max()


def test_mapped_rows_do_not_depend_on_partitions(spark):
    frame = rows_of(spark, np.random.default_rng(6).normal(size=(50, 4)))
    mapping = kernels.map_for("rbf", 4, seed=7, size=16)
    values = lambda df: {r[0]: r[1] for r in kernels.with_kernel_features(df, "x", mapping).select("row_id", vector_to_array("features")).collect()}
    one, many = values(frame.coalesce(1)), values(frame.repartition(7))
    assert all(one[i] == pytest.approx(many[i]) for i in one) and len(one) == 50
    assert values(frame.limit(0)) == {}
    with pytest.raises(Exception, match="null"):
        values(frame.withColumn("x", F.lit(None).cast("array<double>")))
    with pytest.raises(ValueError):
        kernels.map_for("sigmoid", 3)


def blobs(spark, centres, each=60, spread=0.3, seed=8):
    rng = np.random.default_rng(seed)
    x = np.vstack([rng.normal(scale=spread, size=(each, 2)) + c for c in centres])
    df = spark.createDataFrame([(float(a), float(b)) for a, b in x], "a double, b double").repartition(5)
    return x, df


def test_a_sweep_equals_brute_force(spark):
    x, df = blobs(spark, [(0, 0), (10, 0), (0, 10), (10, 10)])
    points = lloyd.points_of(df, ["a", "b"])
    middle, centres, sums, passes = lloyd.fit_all(points, range(1, 7))
    scores = lloyd.silhouettes(points, middle, centres, sums)
    assert passes < 60
    for k in range(1, 7):
        apart = ((x[:, None, :] - (centres[k] + middle)[None]) ** 2).sum(axis=2)
        assert sums[sums["k"] == k]["cost"].sum() == pytest.approx(apart.min(axis=1).sum())
        if k == 1:
            assert scores[1] is None and (centres[1] + middle)[0] == pytest.approx(x.mean(axis=0))
            continue
        own, pairs = apart.argmin(axis=1), ((x[:, None] - x[None]) ** 2).sum(axis=2)
        values = []
        for i in range(len(x)):
            means = {c: pairs[i][own == c].mean() for c in range(k) if c != own[i] and (own == c).any()}
            n = (own == own[i]).sum()
            a, b = pairs[i][own == own[i]].sum() / max(n - 1, 1), min(means.values())
            values.append((b - a) / max(a, b) if n > 1 else 0.0)
        assert scores[k] == pytest.approx(np.mean(values), abs=1e-9)
    assert max(scores, key=lambda k: scores[k] or -1) == 4


def test_a_sweep_is_as_good_as_single_fits(spark, star):
    from tallyloom.plans import frames

    columns = ["sales", "quantity", "discount"]
    features = clustering.standardised(frames.staged_customer_features(star, [1995]), columns)
    ks = [1, 2, 3, 5, 8]
    sweep = {r["k"]: r["wcss"] for r in clustering.choose_k(features, columns, ks, silhouettes=False).collect()}
    vectors = clustering.assemble(features, columns)
    for k in ks[1:]:
        assert sweep[k] <= 1.1 * KMeans(k=k, seed=0, maxIter=1000).fit(vectors).summary.trainingCost
    assert [sweep[k] for k in ks] == sorted(sweep.values(), reverse=True)


def test_sweeps_of_odd_rows(spark):
    same = spark.createDataFrame([(1.0, 2.0)] * 9, "a double, b double")
    assert [tuple(r) for r in clustering.choose_k(same, ["a", "b"], [1, 3]).collect()] == [(1, 0.0, None), (3, 0.0, None)]
    assert [tuple(r) for r in clustering.choose_k(same.limit(0), ["a", "b"], [2]).collect()] == [(2, 0.0, None)]
    two = spark.createDataFrame([(1.0, 0.0), (1.0, 0.0), (5.0, 0.0)], "a double, b double")
    assert [tuple(r) for r in clustering.choose_k(two, ["a", "b"], [2, 5]).collect()] == [(2, 0.0, pytest.approx(2 / 3)), (5, 0.0, pytest.approx(2 / 3))]
    with pytest.raises(Exception, match="null"):
        clustering.choose_k(two.withColumn("b", F.lit(None).cast("double")), ["a", "b"], [2]).collect()


def test_the_order_table_of_a_csv_star(spark, star, tmp_path):
    dims = {"Dim_Customer": star.customer, "Dim_Product": star.product, "Dim_Geography": star.geography, "Dim_Market": star.market,
            "Dim_Priority": star.priority, "Dim_Ship_Mode": star.ship_mode,
            "Dim_Date": star.date.withColumn("date", F.date_format("date", "yyyy-MM-dd HH:mm:ss.SSS"))}
    plain = fact_sales(star).withColumn("row_id", F.xxhash64("row_id"))
    fact = star.lines.join(star.headers, "order_key").join(star.locations, "customer_key").withColumn("row_id", F.xxhash64("row_id"))

    def write(folder, name, df, more=()):
        names = [n for n, _ in CSV_SCHEMAS.get(name, [])] + list(more)
        columns = [F.col(n.lower().replace(" ", "_")).alias(n) for n in names]
        df.select(*columns).coalesce(1).write.option("header", True).csv(f"{folder}/{name}.csv")

    for folder, facts, more in ((tmp_path / "with", fact, ["Order Key"]), (tmp_path / "without", plain, [])):
        write(folder, "Fact_Sales", facts, more)
        for name, df in dims.items():
            write(folder, name, df)
    orders = star.headers.withColumn("order_id", F.concat(F.lit("CA-"), F.col("order_key").cast("string")))
    write(tmp_path / "with", "Dim_Order_Lookup", orders.filter("order_key % 2 = 0"), ["Order ID", "Order Key", "Customer Key"])
    back = star_from_csv(spark, str(tmp_path / "with"))
    joined = with_order_lookup(back)
    assert joined.count() == star.lines.filter("order_key % 2 = 0").count() > 0
    assert joined.filter("order_id <> concat('CA-', order_key)").count() == 0
    assert dict(joined.dtypes)["order_key"] == "bigint" and joined.columns.count("customer_key") == 1
    assert joined.select("row_id", "order_key", "customer_key", "order_date_key").count() > 0
    bare = star_from_csv(spark, str(tmp_path / "without"))
    assert isinstance(bare, Star) and bare.order_lookup is None
    with pytest.raises(ValueError):
        with_order_lookup(bare)


def test_machines_equal_a_dense_minimum(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(300, 3))
    label = (x @ [1.0, -2.0, 0.5] + rng.normal(scale=0.8, size=300) > 0.3).astype(float)
    frame = rows_of(spark, x, label=label)
    machines = fit_machines(frame, "x", "label", (0.01, 1.0, 20.0))
    assert machines.converged and machines.passes < 40
    z, y = np.hstack([x, np.ones((300, 1))]), 2 * label - 1
    for c, w in zip(machines.penalties, machines.weights):
        short = np.maximum(1 - y * (z @ w), 0)
        gradient = np.append(w[:-1], 0.0) - 2 * c * (short * y) @ z
        assert np.abs(gradient).max() < 1e-3 * (1 + c * 300)
        objective = lambda v: 0.5 * (v[:-1] ** 2).sum() + c * (np.maximum(1 - y * (z @ v), 0) ** 2).sum()  # noqa: E731, B023
        # No point of a small sphere around the weights is better.
        assert all(objective(w + 0.05 * d) > objective(w) for d in rng.normal(size=(50, 4)))
    margins = {r["row_id"]: r["margins"] for r in with_margins(frame, "x", machines).collect()}
    assert all(margins[i] == pytest.approx(list(machines.weights @ z[i])) for i in range(300))
    empty = fit_machines(frame.limit(0), "x", "label", (1.0,))
    assert with_margins(frame, "x", empty).first()["margins"] == [0.0]


def test_kernel_machines_separate_rings(spark):
    rng = np.random.default_rng(10)
    label = rng.integers(2, size=900).astype(float)
    angle, radius = rng.uniform(0, 2 * np.pi, 900), 1 + label + rng.normal(scale=0.1, size=900)
    frame = rows_of(spark, np.column_stack([radius * np.cos(angle), radius * np.sin(angle)]), label=label)
    hit = {}
    maps = {"linear": None, "rbf": kernels.map_for("rbf", 2, seed=5), "poly": kernels.sketch_map(2, 2, shift=1.0, seed=5)}
    for name, mapping in maps.items():
        machines = fit_machines(frame.filter("row_id % 3 > 0"), "x", "label", (1.0,), mapping)
        scored = with_margins(frame.filter("row_id % 3 = 0"), "x", machines)
        hit[name] = scored.agg(F.avg(((F.col("margins")[0] > 0) == (F.col("label") > 0)).cast("int"))).first()[0]
    assert hit["linear"] < 0.75 and hit["rbf"] > 0.97 and hit["poly"] > 0.97
