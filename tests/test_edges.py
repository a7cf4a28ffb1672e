"""Small inputs with answers worked out by hand."""

import math

import pytest
from pyspark.sql import functions as F

from tallyloom.functions import columns as c
from tallyloom.operators import aggregates as agg
from tallyloom.operators import encoding as enc
from tallyloom.operators import metrics, scaling, splits
from tallyloom.operators.chart_data import histogram
from tallyloom.operators.hypothesis import mann_whitney
from tallyloom.operators.order_statistics import exact_quantiles, indicator_quantiles, running_totals
from tallyloom.plans import frames
from tallyloom.sources.star import denormalise, star_integrity


def values(df, column):
    return [r[column] for r in df.collect()]


def test_bin_edges(spark):
    df = spark.createDataFrame(
        [(i, x) for i, x in enumerate([0.0, 0.25, 0.2501, 0.5, 0.75, 1.0, -0.1, 1.1, None])], "i int, x double"
    )
    got = values(df.orderBy("i").select(c.cut(F.col("x"), c.LABEL_EDGES, c.LABEL_NAMES).alias("b")), "b")
    assert got == ["Low", "Low", "Potential Low", "Potential Low", "Potential High", "High", None, None, None]


def test_zero_spread_columns(spark):
    df = spark.createDataFrame([(0.0, 7.0)] * 9 + [(1.0, 7.0)], "x double, k double")
    assert sorted(values(scaling.fit_robust(df, ["x"]).transform(df), "x")) == [0.0] * 9 + [1.0]
    assert set(values(scaling.fit_minmax(df, ["k"]).transform(df), "k")) == {0.0}
    assert set(values(scaling.fit_standard(df, ["k"]).transform(df), "k")) == {0.0}


def test_log_scaling_is_undone(spark):
    df = spark.createDataFrame([(float(x),) for x in (0.5, 3, 70, 900.25)], "x double")
    fitted = scaling.fit_log_minmax(df, ["x"], shift=1.0)
    there = fitted.transform(df)
    assert min(values(there, "x")) == 0.0 and max(values(there, "x")) == 1.0
    assert values(fitted.inverse(there), "x") == pytest.approx(values(df, "x"), abs=1e-9)


def test_scaler_uses_the_fitted_rows_only(spark):
    train = spark.createDataFrame([(0.0,), (10.0,)], "x double")
    test = spark.createDataFrame([(20.0,)], "x double")
    assert values(scaling.fit_minmax(train, ["x"]).transform(test), "x") == [2.0]


def test_dropped_first_level(spark):
    df = spark.createDataFrame([("A",), ("B",), ("C",)], "s string")
    coded = enc.dummies(df, {"s": ["A", "B", "C"]}, {"s": "s"})
    assert coded.columns == ["s", "s_B", "s_C"]
    merged = enc.merged_levels(coded, "s_", "m").orderBy("s")
    assert values(merged, "m") == ["B", "B", "C"]
    assert enc.dummies(df, {"s": ["A", "B", "C"]}, {}, drop_first=False).columns == ["s", "s_A", "s_B", "s_C"]


def test_one_hot_keeps_levels_and_rejects_new_ones(spark):
    train = spark.createDataFrame([("A",), ("B",)], "s string")
    model = enc.feature_pipeline([], ["s"]).fit(train)
    assert model.transform(train).first()["features"].size == 2
    with pytest.raises(Exception):
        model.transform(spark.createDataFrame([("Z",)], "s string")).collect()


def test_too_many_levels(spark):
    with pytest.raises(ValueError):
        enc.fit_levels(spark.range(3000).select(F.col("id").cast("string").alias("s")), ["s"])


def test_tied_top_values(spark):
    df = spark.createDataFrame([(v,) for v in "aaabbccd"], "v string")
    assert values(agg.top_values(df, "v", 2), "v") == ["a", "b"]
    grouped = agg.group_rare(df, "v", 2, "g").groupBy("g").count().collect()
    assert {r["g"]: r["count"] for r in grouped} == {"a": 3, "b": 2, "Other": 3}


def test_discount_groups(spark, star):
    lines = spark.createDataFrame(
        [("1", 1.0, 0.0), ("2", 1.0, 0.1), ("3", 1.0, None), ("4", 1.0, -0.1)], "row_id string, quantity double, discount double"
    )
    import dataclasses

    got = {r["row_id"]: r["discount_type"] for r in frames.discount_groups(dataclasses.replace(star, lines=lines)).collect()}
    assert got == {"1": "No Discount", "2": "Discounted"}


def test_orphans_and_duplicate_keys(spark, star):
    import dataclasses

    lines = star.lines.limit(1).withColumn("product_key", F.lit(-1).cast("bigint")).unionByName(
        star.lines.limit(1).withColumn("product_key", F.lit(-2).cast("bigint"))
    )
    product = spark.createDataFrame([(-2, "x", "y"), (-2, "x", "z")], "product_key bigint, category string, sub_category string")
    broken = dataclasses.replace(star, lines=lines, product=product)
    assert denormalise(broken, ["product"]).count() == 2
    row = star_integrity(broken).filter("dimension = 'product'").first()
    assert (row["duplicate_keys"], row["orphan_rows"]) == (1, 1)


def test_zero_divisors(spark):
    df = spark.createDataFrame([(5.0, 0.0)], "a double, b double")
    row = df.select(
        c.ratio(F.col("a"), F.col("b")).alias("r"), c.guarded_ratio(F.col("a"), F.col("b")).alias("g"), F.ln("b").alias("l")
    ).first()
    assert row["r"] is None and row["g"] == 5.0 / 1e-6 and row["l"] is None


def test_null_is_not_above(spark):
    df = spark.createDataFrame([(None,), (2.0,)], "x double")
    assert sorted(values(df.select(c.flag_above(F.col("x"), F.lit(1.0)).alias("f")), "f")) == [0, 1]


def test_quantiles(spark):
    df = spark.range(10).select(F.col("id").cast("double").alias("x"))
    got = {r["prob"]: r["value"] for r in exact_quantiles(df, ["x"], [0.0, 0.25, 0.5, 1.0]).collect()}
    assert got == {0.0: 0.0, 0.25: 2.25, 0.5: 4.5, 1.0: 9.0}
    middle = exact_quantiles(df, ["x"], [0.25], interpolation="midpoint").first()
    assert middle["value"] == 2.5


@pytest.mark.parametrize("by", [None, "g"])
def test_quantiles_with_narrow_brackets(spark, by):
    """A sketch much coarser than the data must still give exact answers, hot values included."""
    df = spark.range(20_000).select(
        (F.col("id") % 2).cast("string").alias("g"),
        F.when(F.col("id") % 3 == 0, F.lit(0.5)).otherwise(F.rand(7)).alias("x"),
    ).cache()
    probs = [0.01, 0.25, 0.5, 0.75, 0.99]
    got = exact_quantiles(df, ["x"], probs, by=by, accuracy=100).collect()
    for r in got:
        rows = df.filter(F.col("g") == r["g"]) if by else df
        assert r["value"] == pytest.approx(rows.agg(F.percentile("x", r["prob"])).first()[0], abs=1e-12)
    assert len(got) == len(probs) * (2 if by else 1)


def test_indicator_quantiles(spark):
    df = spark.createDataFrame([(1,)] * 3 + [(0,)] * 7, "f int")
    got = indicator_quantiles(df, ["f"], [0.25, 0.5, 0.75])
    want = {p: df.agg(F.percentile("f", p)).first()[0] for p in (0.25, 0.5, 0.75)}
    assert {p: got["f", p] for p in want} == want


def test_running_totals_in_many_ranges(spark):
    counted = spark.range(1000).select((F.col("id") * 3).cast("double").alias("v"), (F.col("id") % 5 + 1).alias("t"))
    got = {r["v"]: r["before_t"] for r in running_totals(counted, "v", ["t"], rows_per_window=70).collect()}
    total = 0
    for i in range(1000):
        assert got[i * 3.0] == total
        total += i % 5 + 1


def test_tied_ranks_and_exact_p(spark):
    rows = [("a", x) for x in (1.0, 2.0, 2.0)] + [("b", x) for x in (2.0, 3.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    assert mann_whitney(df, "x", "g", "a", "b").first()["u_statistic"] == 1.0
    # Worked example of the test: exact and approximate p are known.
    males, females = [19, 22, 16, 29, 24], [20, 11, 17, 12]
    rows = [("m", float(x)) for x in males] + [("f", float(x)) for x in females]
    row = mann_whitney(spark.createDataFrame(rows, "g string, x double"), "x", "g", "m", "f").first()
    assert row["u_statistic"] == 17.0
    assert row["p_value"] == pytest.approx(0.1111111111, abs=1e-9)
    assert math.erfc(row["z"] / math.sqrt(2)) == pytest.approx(0.11134688653314041, abs=1e-12)


def test_cut_inside_a_date(spark):
    df = spark.createDataFrame(
        [(str(i), 20200101 if i < 2 else 20200102 if i < 8 else 20200103) for i in range(10)], "row_id string, day int"
    )
    def train(frame):
        got = splits.chronological_split(frame, "row_id", "day", 0.5).filter("is_train").collect()
        return {r["row_id"] for r in got}

    first = train(df)
    assert len(first) == 5 and {"0", "1"} <= first
    assert train(df.repartition(7)) == first
    assert len({r["row_id"] for r in splits.chronological_split(df, "row_id", "day", 0.8).filter("is_train").collect()}) == 8


def test_class_never_predicted(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "a"), ("b", "a"), ("b", "a")], "y string, p string")
    row = metrics.accuracy_and_macro_f1(df, "y", "p", ["a", "b"]).first()
    assert row["accuracy"] == 0.5 and row["f1_macro"] == pytest.approx((2 / 3) / 2)
    matrix = {r["label"]: (r["predicted_a"], r["predicted_b"], r["predicted_c"]) for r in metrics.confusion_matrix(df, "y", "p", ["a", "b", "c"]).collect()}
    assert matrix == {"a": (2, 0, 0), "b": (2, 0, 0), "c": (0, 0, 0)}


def test_weekday_and_dates(spark):
    row = spark.range(1).select(
        c.saturday_first_weekday(F.lit("2014-01-04").cast("date")).alias("w"),
        c.parse_date_key(F.lit(20140104)).cast("string").alias("d"),
        c.whole_days(
            c.parse_timestamp(F.lit("2014-01-03 23:00:00.000")), c.parse_timestamp(F.lit("2014-01-04 01:00:00.000"))
        ).alias("back"),
    ).first()
    assert (row["w"], row["d"], row["back"]) == (0, "2014-01-04", -1)


def test_maximum_is_in_the_last_bin(spark):
    df = spark.createDataFrame([(float(x),) for x in range(0, 11)], "x double")
    got = {r["bin"]: r["count"] for r in histogram(df, ["x"], bins=5).collect()}
    assert got == {0: 2, 1: 2, 2: 2, 3: 2, 4: 3}


def test_map_values_unknown_is_null(spark):
    df = spark.createDataFrame([(1,), (9,)], "q int")
    assert values(df.orderBy("q").select(c.map_values(F.col("q"), c.QUARTER_NAMES).alias("n")), "n") == ["Q1", None]


def test_merged_first_level_shares_its_mean(star):
    plain = frames.regression_frame(star).select("row_id", "mean_sale_of_each_sub_cat", "`sub_cat_Brand#10`", "sales")
    merged = frames.regression_frame(star, merge_first_level=True)
    names = [n for n in merged.columns if n.startswith("sub_cat_")]
    rows = merged.withColumn("first", sum(F.col(f"`{n}`") for n in names) == 0)
    both = rows.filter(F.col("first") | (F.col("`sub_cat_Brand#10`") == 1))
    means = {round(r[0], 6) for r in both.select("mean_sale_of_each_sub_cat").distinct().collect()}
    assert means == {round(both.agg(F.avg("sales")).first()[0], 6)}
    assert plain.select(F.round("mean_sale_of_each_sub_cat", 6)).distinct().count() == len(names) + 1


def test_means_of_training_rows_only(star):
    frame = frames.regression_frame(star, train_fraction=0.85)
    second = frame.filter(F.col("`sub_cat_Brand#10`") == 1)
    assert second.filter("is_train").agg(F.avg("sales")).first()[0] == pytest.approx(
        second.select("mean_sale_of_each_sub_cat").first()[0]
    )
    n, train = frame.count(), frame.filter("is_train").count()
    assert train == int(0.85 * n)
