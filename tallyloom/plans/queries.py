"""Every query by name: a function of the session and the folder of the input tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.columns import (
    LABEL_EDGES, LABEL_NAMES, QUARTER_NAMES, WEEKDAY_NAMES, cut, days_between, guarded_ratio, map_values,
    parse_date_key, parse_timestamp, ratio, whole_days, yeo_johnson,
)
from tallyloom.operators import aggregates as agg
from tallyloom.operators import chart_data as charts
from tallyloom.operators import encoding as enc
from tallyloom.operators import hypothesis as hyp
from tallyloom.operators import clustering, metrics, models, scaling, splits
from tallyloom.operators.balancing import smote, smote_nc
from tallyloom.operators.correlation import correlated_pairs, correlation_pairs
from tallyloom.operators.order_statistics import exact_quantiles
from tallyloom.plans import frames, jobs
from tallyloom.session import stage, stage_compact
from tallyloom.sources.sinks import metric_table
from tallyloom.sources.star import (
    DIMENSIONS, MEASURES, Star, denormalise, fact_sales, load_star, star_integrity, with_order_lookup,
)

LABELS = ["Discounted", "No Discount"]

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[Star], DataFrame]) -> Callable[[Star], DataFrame]:
    """Register a function of the star under its own name."""
    REGISTRY[build.__name__] = lambda spark, folder: build(load_star(spark, folder))
    return build


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Round sums and averages, whose last bits depend on the order of addition."""
    return df.withColumns({c: F.round(F.col(f"`{c}`"), digits) for c in columns})


def text_date(column) -> F.Column:
    return F.date_format(column, "yyyy-MM-dd")


# Joins


@query
def star_join(star: Star) -> DataFrame:
    return denormalise(star, DIMENSIONS).select(
        "row_id", *MEASURES, "customer_id", "segment", "category", "sub_category", "city", "state", "country",
        "region", "market", "priority_name", "ship_mode_name", "is_returned",
    )


@query
def fact_keys(star: Star) -> DataFrame:
    return fact_sales(star).select(
        "row_id", "order_date_key", "ship_date_key", "product_key", "customer_key", "geo_key", "priority_key",
        "ship_mode_key", "market_key",
    )


@query
def star_key_integrity(star: Star) -> DataFrame:
    return star_integrity(star)


@query
def role_playing_dates(star: Star) -> DataFrame:
    wide = denormalise(star, [], order_dates=True, ship_dates=True)
    parts = ["year", "quarter", "month", "day", "day_of_week"]
    lag = days_between(F.col("ship_date"), F.col("order_date")).alias("time_difference")
    return wide.select("row_id", *[f"{r}_{p}" for r in ("order", "ship") for p in parts], lag)


@query
def non_returned_lines(star: Star) -> DataFrame:
    return star.lines.filter("is_returned = 0").select("row_id", *MEASURES)


@query
def sorted_by_order_date(star: Star) -> DataFrame:
    wide = denormalise(star, []).select("row_id", "order_date_key")
    return wide.orderBy("order_date_key", "row_id")


# Customers


@query
def customer_metrics(star: Star) -> DataFrame:
    return rounded(frames.customer_metrics(star), 4, *MEASURES)


@query
def customer_year_pivot(star: Star) -> DataFrame:
    return frames.customer_year_pivot(star, frames.order_years(star))


@query
def customer_features(star: Star) -> DataFrame:
    return rounded(frames.customer_features(star, frames.order_years(star)), 4, *MEASURES)


@query
def customer_features_trusted_keys(star: Star) -> DataFrame:
    """As ``customer_features``, without the joins ``star_key_integrity`` shows to be neutral."""
    skip = ["product", "ship_mode", "priority", "market", "geography"]
    return rounded(frames.customer_features(star, frames.order_years(star), skip=skip), 4, *MEASURES)


@query
def lines_per_customer_year(star: Star) -> DataFrame:
    wide = denormalise(star, ["customer"], order_dates=True).filter("is_returned = 0")
    return agg.count_by(wide, ["customer_id", "order_year"], "row_id", "orders_per_year")


# Discount groups


@query
def discount_groups(star: Star) -> DataFrame:
    return frames.discount_groups(star)


@query
def discount_groups_stacked(star: Star) -> DataFrame:
    """The two groups filtered apart and stacked again."""
    lines = star.lines.select("row_id", "quantity", "discount")
    plain = lines.filter("discount = 0").withColumn("discount_type", F.lit("No Discount"))
    reduced = lines.filter("discount > 0").withColumn("discount_type", F.lit("Discounted"))
    return plain.unionByName(reduced)


def quantity_count_table(star: Star) -> DataFrame:
    return agg.count_by(frames.discount_groups(star), ["quantity", "discount_type"], None, "order_count")


@query
def quantity_counts(star: Star) -> DataFrame:
    return quantity_count_table(star)


@query
def quantity_probability(star: Star) -> DataFrame:
    return agg.share_within(quantity_count_table(star), "discount_type", "order_count", "probability")


@query
def group_size(star: Star) -> DataFrame:
    sizes = agg.count_by(frames.discount_groups(star), ["discount_type"], None, "order_count")
    return agg.share_of_total(sizes, "order_count", "group_percent")


def group_moments_table(star: Star) -> DataFrame:
    groups = frames.discount_groups(star)
    median = exact_quantiles(groups, ["quantity"], [0.5], by="discount_type")
    moments = agg.moments_by(groups, "discount_type", "quantity")
    return moments.join(median.select("discount_type", F.col("value").alias("median")), "discount_type").select(
        "discount_type", "mean", "median", "std_dev"
    )


@query
def group_moments(star: Star) -> DataFrame:
    return rounded(group_moments_table(star), 6, "mean", "std_dev")


# Top-k grouping


@query
def top_countries(star: Star) -> DataFrame:
    return agg.top_values(denormalise(star, ["geography"]).filter("is_returned = 0"), "country", 10)


@query
def country_grouped(star: Star) -> DataFrame:
    wide = denormalise(star, ["geography"]).filter("is_returned = 0").select("row_id", "country")
    return agg.group_rare(wide, "country", 10, "country_grouped")


# Row expressions


@query
def price_features(star: Star) -> DataFrame:
    sales, quantity, discount = F.col("sales"), F.col("quantity"), F.col("discount")
    return star.lines.select(
        "row_id", ratio(sales, quantity).alias("price_per_unit"), (sales * discount).alias("discount_amount"),
        (discount * discount).alias("powered_discount"),
    )


@query
def ship_mode_ratios(star: Star) -> DataFrame:
    return star.lines.select(
        "row_id", guarded_ratio(F.col("profit"), F.col("sales")).alias("profit_margin"),
        guarded_ratio(F.col("sales"), F.col("quantity")).alias("sales_per_unit"),
    )


@query
def sales_discount_labels(star: Star) -> DataFrame:
    top = frames.scalar_of(star.lines, sales=F.max("sales"), discount=F.max("discount"))
    label = lambda c, top_c: cut(F.col(c) / top_c, LABEL_EDGES, LABEL_NAMES)
    return star.lines.select(
        "row_id",
        label("sales", F.greatest(top["sales"], F.lit(1.0))).alias("sales_label"),
        label("discount", F.greatest(top["discount"], F.lit(1.0))).alias("discount_label"),
        label("discount", top["discount"]).alias("discount_label_no_floor"),
    )


@query
def log_sales(star: Star) -> DataFrame:
    logged = F.ln(F.col("sales"))
    return star.lines.select(
        "row_id", F.round(logged, 9).alias("log_sales"), F.round(F.exp(logged), 4).alias("sales_again"),
        F.round(F.ln("shipping_cost"), 9).alias("log_shipping_cost"),
    )


@query
def calendar_names(star: Star) -> DataFrame:
    wide = denormalise(star, [], ship_dates=True)
    return wide.select(
        "row_id", map_values(F.col("ship_quarter"), QUARTER_NAMES).alias("quarter_name"),
        map_values(F.col("ship_day_of_week"), WEEKDAY_NAMES).alias("weekday_name"),
    )


@query
def years_since_start(star: Star) -> DataFrame:
    wide = denormalise(star, [], ship_dates=True).filter("is_returned = 0")
    first = frames.scalar_of(wide, year=F.min("ship_year"))["year"]
    return wide.select("row_id", (F.col("ship_year") - first).alias("years_since_start"))


@query
def profit_above_minimum(star: Star) -> DataFrame:
    low = frames.scalar_of(star.lines, profit=F.min("profit"))["profit"]
    return star.lines.select("row_id", (F.col("profit") - low).alias("shifted_profit"))


# Dates


@query
def date_parse(star: Star) -> DataFrame:
    return star.headers.select(
        "order_key", text_date(parse_date_key(F.col("order_date_key"))).alias("order_date"),
    )


@query
def order_month(star: Star) -> DataFrame:
    return star.headers.select("order_key", F.month(parse_date_key(F.col("order_date_key"))).alias("order_month"))


@query
def ship_lag_days(star: Star) -> DataFrame:
    wide = denormalise(star, [])
    lag = days_between(parse_date_key(F.col("ship_date_key")), parse_date_key(F.col("order_date_key")))
    return wide.select("row_id", lag.alias("shipping_lag_days"))


# Encoders


@query
def dummy_columns(star: Star) -> DataFrame:
    wide = denormalise(star, ["product", "customer"]).select("row_id", "sub_category", "segment")
    columns = ["sub_category", "segment"]
    return enc.dummies(wide, enc.fit_levels(wide, columns), frames.DUMMY_PREFIXES).drop(*columns)


@query
def one_hot_columns(star: Star) -> DataFrame:
    wide = denormalise(star, ["customer", "ship_mode"]).select("row_id", "segment", "ship_mode_name")
    columns = ["segment", "ship_mode_name"]
    return enc.dummies(wide, enc.fit_levels(wide, columns), {}, drop_first=False).drop(*columns)


@query
def label_codes(star: Star) -> DataFrame:
    wide = denormalise(star, ["priority", "ship_mode"]).select("row_id", "priority_name", "ship_mode_name")
    return enc.code_labels(wide, ["priority_name", "ship_mode_name"]).drop("priority_name", "ship_mode_name")


@query
def sub_cat_mean_sales(star: Star) -> DataFrame:
    wide = denormalise(star, ["product"]).filter("is_returned = 0").select("row_id", "sub_category", "sales")
    frame = enc.group_statistic(wide, "sub_category", F.avg("sales"), "mean_sale_of_each_sub_cat")
    return rounded(frame, 4, "mean_sale_of_each_sub_cat").drop("sales")


@query
def sub_cat_mean_sales_merged(star: Star) -> DataFrame:
    """As ``sub_cat_mean_sales``, on the level named by the dummies, where the first two levels are one."""
    wide = denormalise(star, ["product"]).filter("is_returned = 0").select("row_id", "sub_category", "sales")
    coded = enc.dummies(wide, enc.fit_levels(wide, ["sub_category"]), frames.DUMMY_PREFIXES)
    merged = enc.merged_levels(coded, "sub_cat_", "merged")
    frame = enc.group_statistic(merged, "merged", F.avg("sales"), "mean_sale_of_each_sub_cat")
    return rounded(frame, 4, "mean_sale_of_each_sub_cat").select(
        "row_id", "sub_category", "merged", "mean_sale_of_each_sub_cat"
    )


@query
def market_sum_sales(star: Star) -> DataFrame:
    wide = denormalise(star, ["market"]).filter("is_returned = 0").select("row_id", "market", "sales")
    frame = enc.group_statistic(wide, "market", F.sum("sales"), "sum_sale_of_each_market")
    return rounded(frame, 4, "sum_sale_of_each_market").drop("sales")


@query
def market_median_sales(star: Star) -> DataFrame:
    return rounded(frames.market_median_sales(star), 6, "median_sale_of_each_market")


@query
def country_frequency(star: Star) -> DataFrame:
    return frames.country_frequency(star)


@query
def threshold_flags(star: Star) -> DataFrame:
    return frames.threshold_flags(star)


@query
def optional_date_features(star: Star) -> DataFrame:
    return frames.optional_date_features(star)


@query
def optional_amount_features(star: Star) -> DataFrame:
    frame = frames.optional_amount_features(star)
    return rounded(frame, 9, *[c for c in frame.columns if c != "row_id"])


@query
def optional_dummies(star: Star) -> DataFrame:
    return frames.optional_dummies(star)


# Feature frames


@query
def order_features(star: Star) -> DataFrame:
    return frames.order_features(star)


@query
def ship_mode_frame(star: Star) -> DataFrame:
    return frames.ship_mode_frame(star)


@query
def ship_mode_frame_plain(star: Star) -> DataFrame:
    return frames.ship_mode_frame_plain(star)


@query
def regression_frame(star: Star) -> DataFrame:
    frame = rounded(frames.regression_frame(star), 4, "mean_sale_of_each_sub_cat")
    return rounded(frame, 1, "mean_sub_cat_sale_powered")


@query
def regression_frame_thresholds(star: Star) -> DataFrame:
    return rounded(frames.regression_frame_thresholds(star), 4, "sum_sale_of_each_market")


# Profiles


@query
def segment_crosstab(star: Star) -> DataFrame:
    return agg.crosstab(denormalise(star, ["customer"]), "is_returned", "segment")


@query
def value_frequencies(star: Star) -> DataFrame:
    columns = ["segment", "ship_mode_name", "category", "priority_name", "region"]
    return agg.frequencies(denormalise(star, DIMENSIONS), columns)


@query
def frequencies_by_return(star: Star) -> DataFrame:
    wide = denormalise(star, ["customer", "ship_mode"])
    return agg.frequencies(wide, ["segment", "ship_mode_name"], hue="is_returned")


@query
def correlation_matrix(star: Star) -> DataFrame:
    return rounded(correlation_pairs(star.lines, MEASURES, diagonal=True), 6, "corr")


@query
def high_correlations(star: Star) -> DataFrame:
    lines = star.lines.filter("is_returned = 0").withColumns(
        {
            "price_per_unit": ratio(F.col("sales"), F.col("quantity")),
            "discount_amount": F.col("sales") * F.col("discount"),
            "powered_discount": F.col("discount") * F.col("discount"),
        }
    )
    columns = [*MEASURES, "price_per_unit", "discount_amount", "powered_discount"]
    return rounded(
        correlated_pairs(lines, columns, "profit"), 4, "corr_percent", "target_percent_a", "target_percent_b"
    )


@query
def measure_quantiles(star: Star) -> DataFrame:
    return rounded(exact_quantiles(star.lines, MEASURES, [0.25, 0.5, 0.75]), 6, "value")


@query
def box_stats(star: Star) -> DataFrame:
    return rounded(charts.box_stats(star.lines, MEASURES), 6, "q1", "median", "q3")


@query
def box_stats_by_ship_mode(star: Star) -> DataFrame:
    wide = stage(denormalise(star, ["ship_mode"]).select("ship_mode_name", "sales", "profit"))
    return rounded(charts.box_stats(wide, ["sales", "profit"], by="ship_mode_name"), 6, "q1", "median", "q3")


@query
def histogram(star: Star) -> DataFrame:
    return rounded(charts.histogram(star.lines, ["sales", "quantity", "discount", "profit"]), 6, "low", "high")


@query
def kde_grid(star: Star) -> DataFrame:
    return charts.kernel_density(star.lines, "sales").select("point", F.round("x", 4).alias("x"), F.round("density", 12).alias("density"))


@query
def scatter_points(star: Star) -> DataFrame:
    return charts.scatter_points(star.lines, "row_id", MEASURES)


@query
def profit_within_fences(star: Star) -> DataFrame:
    lines = star.lines.filter("is_returned = 0").select("row_id", "profit")
    return charts.midpoint_outlier_filter(lines, "profit")


# Scalers


def scaled_columns(star: Star, fit, columns: list[str], digits: int = 8) -> DataFrame:
    lines = star.lines.select("row_id", *columns)
    return rounded(fit(lines, columns).transform(lines), digits, *columns)


@query
def robust_scale(star: Star) -> DataFrame:
    return scaled_columns(star, scaling.fit_robust, MEASURES)


@query
def minmax_scale(star: Star) -> DataFrame:
    return scaled_columns(star, scaling.fit_minmax, ["quantity", "discount"])


@query
def log_minmax_scale(star: Star) -> DataFrame:
    return scaled_columns(star, scaling.fit_log_minmax, ["sales"])


@query
def standard_scale(star: Star) -> DataFrame:
    return scaled_columns(star, scaling.fit_standard, ["profit"], 6)


# Splits


@query
def hash_split(star: Star) -> DataFrame:
    return splits.hash_split(star.lines.select("row_id"), "row_id", 80)


@query
def chrono_split(star: Star) -> DataFrame:
    # Staged: the split reads its rows several times, and the lines are to meet their orders once.
    wide = stage(denormalise(star, []).filter("is_returned = 0").select("row_id", "order_date_key"))
    return splits.chronological_split(wide, "row_id", "order_date_key", 0.85)


@query
def chrono_split_validation(star: Star) -> DataFrame:
    """A second chronological cut, inside the training part of the first."""
    train = chrono_split(star).filter("is_train").select("row_id", "order_date_key")
    return splits.chronological_split(train, "row_id", "order_date_key", 0.85)


@query
def stratified_split(star: Star) -> DataFrame:
    wide = stage(denormalise(star, ["ship_mode"]).select("row_id", "ship_mode_name"))
    return splits.stratified_split(wide, "row_id", "ship_mode_name", 0.75)


@query
def sample_per_group(star: Star) -> DataFrame:
    groups = frames.discount_groups(star)
    return splits.sample_rows(groups, "row_id", 5000, by="discount_type").select("row_id", "discount_type", "quantity")


# Hypothesis test


@query
def mann_whitney_u(star: Star) -> DataFrame:
    table = hyp.mann_whitney(frames.discount_groups(star), "quantity", "discount_type", *LABELS)
    return rounded(table, 9, "z").drop("p_value")


@query
def average_ranks(star: Star) -> DataFrame:
    """Average rank of each quantity over both discount groups."""
    counted = frames.discount_groups(star).groupBy("quantity").agg(F.count(F.lit(1)).alias("t"))
    ranked = hyp.running_totals(counted, "quantity", ["t"])
    return ranked.select("quantity", "t", (F.col("before_t") + (F.col("t") + 1) / 2).alias("average_rank"))


@query
def qq_points(star: Star) -> DataFrame:
    points = hyp.qq_points(star.lines, "profit")
    return points.select(F.round("theoretical", 9).alias("theoretical"), "ordered")


@query
def qq_line(star: Star) -> DataFrame:
    return rounded(hyp.qq_line(hyp.qq_points(star.lines, "profit")), 6, "slope", "intercept", "r")


@query
def shapiro_wilk_raw(star: Star) -> DataFrame:
    return hyp.shapiro_wilk(frames.discount_groups(star), "quantity", "discount_type")


@query
def yeo_johnson_summary(star: Star) -> DataFrame:
    groups = frames.discount_groups(star)
    powers = hyp.yeo_johnson_powers(groups, "quantity", "discount_type", LABELS)
    return jobs.yeo_johnson_summary(
        hyp.yeo_johnson_transformed(groups, "quantity", "discount_type", powers, "transformed"), powers
    )


@query
def yeo_johnson_values(star: Star) -> DataFrame:
    """The transform of profit, which has both signs, at a given exponent."""
    value = yeo_johnson(F.col("profit") / 1000.0, F.lit(0.75))
    return star.lines.select("row_id", F.round(value, 7).alias("transformed"))


@query
def discount_qq_plot(star: Star) -> DataFrame:
    return jobs.discount_report(star)["qq_plot"]


@query
def mannwhitney_summary(star: Star) -> DataFrame:
    return jobs.mannwhitney_summary(frames.discount_groups(star))


# Reports


@query
def global_aggregates(star: Star) -> DataFrame:
    one = star.lines.agg(
        F.count(F.lit(1)).alias("rows"), F.max("sales").alias("max_sales"), F.min("sales").alias("min_sales"),
        F.round(F.avg("sales"), 4).alias("mean_sales"),
        F.round(F.avg((F.col("discount") > 0).cast("double")) * 100, 0).alias("discounted_percent"),
    )
    return metric_table(one)


@query
def timestamp_lag(star: Star) -> DataFrame:
    """Whole days between timestamps parsed from text."""
    wide = denormalise(star, [], order_dates=True, ship_dates=True)
    moment = lambda day: parse_timestamp(F.concat(text_date(day), F.lit(" 00:00:00.000")))
    return wide.select("row_id", whole_days(moment("ship_date"), moment("order_date")).alias("time_difference"))


@query
def order_lookup_join(star: Star) -> DataFrame:
    """Lines joined to the order table on the order key."""
    return with_order_lookup(star).select("row_id", "order_key", "customer_key", "order_date_key")


def rule_predictions(star: Star) -> DataFrame:
    """Ship mode guessed from the line's amounts: a fixed rule, so that the scores can be checked."""
    rule = (
        F.when(F.col("discount") > 0.07, "Standard Class").when(F.col("quantity") > 35, "First Class")
        .when(F.col("sales") > 30000, "Same Day").otherwise("Standard Class")
    )
    return denormalise(star, ["ship_mode"]).select("row_id", "ship_mode_name", rule.alias("predicted"))


@query
def confusion_matrix(star: Star) -> DataFrame:
    return metrics.confusion_matrix(rule_predictions(star), "ship_mode_name", "predicted", ship_mode_names(star))


@query
def classification_report(star: Star) -> DataFrame:
    report = metrics.classification_report(rule_predictions(star), "ship_mode_name", "predicted", ship_mode_names(star))
    return rounded(report, 9, "precision", "recall", "f1")


@query
def accuracy_and_macro_f1(star: Star) -> DataFrame:
    scores = metrics.accuracy_and_macro_f1(rule_predictions(star), "ship_mode_name", "predicted", ship_mode_names(star))
    return rounded(scores, 9, "accuracy", "f1_macro")


def rule_regression(star: Star) -> DataFrame:
    guess = F.col("sales") * 0.1 - F.col("quantity") * 5
    return hash_marked(star.lines).select("profit", guess.alias("predicted"), "is_train")


def hash_marked(lines: DataFrame) -> DataFrame:
    return splits.hash_split(lines, "row_id", 80)


@query
def regression_metrics(star: Star) -> DataFrame:
    return rounded(metrics.regression_metrics(rule_regression(star), "profit", "predicted"), 4, "r2", "mse", "rmse", "mae")


@query
def regression_table(star: Star) -> DataFrame:
    return rounded(metrics.regression_table(rule_regression(star), "profit", "predicted", "is_train"), 4, "value")


# Customers in clusters

def customer_columns(star: Star) -> list[str]:
    return [*MEASURES, *[f"year_{y}" for y in frames.order_years(star)]]


def ship_mode_names(star: Star) -> list[str]:
    return agg.levels_of(star.ship_mode, "ship_mode_name")


@query
def segmented_customers(star: Star) -> DataFrame:
    return jobs.segmented_customers(star, frames.order_years(star))


@query
def cluster_profile_raw(star: Star) -> DataFrame:
    return jobs.cluster_profile(star, frames.order_years(star), 3)


@query
def cluster_profile_scaled(star: Star) -> DataFrame:
    return jobs.cluster_profile(star, frames.order_years(star), 5)


@query
def profile_by_rule(star: Star) -> DataFrame:
    """The cluster profile on groups made by a fixed rule."""
    frame = frames.customer_features(star, frames.order_years(star)).withColumn("cluster", _rule_cluster())
    profile = agg.profile_by(frame, "cluster", MEASURES)
    return rounded(profile, 4, *[c for c in profile.columns if c not in ("cluster", "customers")])


def _rule_cluster() -> F.Column:
    return F.when(F.col("quantity") > 800, 2).when(F.col("quantity") > 500, 1).otherwise(0)


@query
def choose_k_raw(star: Star) -> DataFrame:
    """Within-cluster sums of squares and silhouettes for k from 1 to 20."""
    return clustering.choose_k(frames.customer_features(star, frames.order_years(star)), customer_columns(star), range(1, 21))


@query
def choose_k_scaled(star: Star) -> DataFrame:
    features = frames.staged_customer_features(star, frames.order_years(star))
    return clustering.choose_k(clustering.standardised(features, customer_columns(star)), customer_columns(star), range(1, 21))


@query
def silhouette_rows(star: Star) -> DataFrame:
    """Silhouette of every customer, in groups made by a fixed rule."""
    frame = stage(frames.customer_features(star, frames.order_years(star))).withColumn("cluster", _rule_cluster())
    scored = clustering.silhouette_rows(frame, "customer_id", ["quantity", "discount", "year_1995"], "cluster")
    return rounded(scored, 8, "silhouette")


@query
def cluster_quality(star: Star) -> DataFrame:
    frame = stage(frames.customer_features(star, frames.order_years(star))).withColumn("cluster", _rule_cluster())
    quality = clustering.cluster_quality(frame, "customer_id", ["quantity", "discount", "year_1995"], "cluster")
    return rounded(quality, 4, "inertia", "silhouette")


@query
def cluster_scatter(star: Star) -> DataFrame:
    return clustering.cluster_scatter(jobs.segmented_customers(star, frames.order_years(star)), "customer_id", customer_columns(star), "cluster_k3_raw")


# Returned orders


@query
def smote_counts(star: Star) -> DataFrame:
    """Rows per class after balancing, original and synthetic."""
    train, _ = jobs.prepared_orders(star)
    return smote(train, "row_id", "is_returned", "x").groupBy("is_returned", "is_synthetic").agg(F.count(F.lit(1)).alias("rows"))


@query
def smote_nc_counts(star: Star) -> DataFrame:
    """Rows per ship mode after balancing mixed columns, original and synthetic."""
    label, numbers = "ship_mode_name", ["sales", "quantity", "discount", "profit"]
    categories = ["priority_name", "market", "segment", "sales_label", "discount_label"]
    frame = stage_compact(frames.ship_mode_frame(star).select("row_id", label, *numbers, *categories))
    frame = splits.stratified_split(frame, "row_id", label, 0.75).filter("is_train")
    made = smote_nc(frame, "row_id", label, numbers, categories, enc.fit_levels(frame, categories))
    return made.groupBy(label, "is_synthetic").agg(F.count(F.lit(1)).alias("rows"))


@query
def returned_predictions(star: Star) -> DataFrame:
    return jobs.returned_classifier(star)[2]


@query
def returned_prediction_ids(star: Star) -> DataFrame:
    """Every test row, scored or not, with its true label: what the predictions must cover."""
    return jobs.returned_classifier(star)[2].select("row_id", "true_label")


@query
def returned_importances(star: Star) -> DataFrame:
    model, train, _ = jobs.returned_classifier(star)
    return models.importances(model, train)


@query
def knn_returned(star: Star) -> DataFrame:
    return jobs.knn_returned(star)


@query
def grid_scores(star: Star) -> DataFrame:
    """Scores of random forest, nearest neighbours and logistic regression over their parameters."""
    return jobs.grid_scores(star)


@query
def best_candidates(star: Star) -> DataFrame:
    """The best candidate of each family."""
    return models.best_per_family(jobs.grid_scores(star))


@query
def svc_scores(star: Star) -> DataFrame:
    return jobs.grid_scores(star, families=("svm",))


@query
def svc_kernel_scores(star: Star) -> DataFrame:
    """Scores of support-vector machines over penalties and kernels."""
    return jobs.grid_scores(star, families=("kernel_svm",))


# Boosting, at the jobs' full settings


@query
def profit_metrics(star: Star) -> DataFrame:
    return jobs.profit_model(star)["metrics"]


@query
def profit_predictions(star: Star) -> DataFrame:
    return jobs.profit_model(star)["predictions"]


@query
def profit_importances(star: Star) -> DataFrame:
    return jobs.profit_model(star)["importances"]


@query
def profit_early_stop_metrics(star: Star) -> DataFrame:
    """Metrics of the model with patience, and how many rounds it ran and kept."""
    results = jobs.profit_model_early_stop(star)
    return results["metrics"].unionByName(results["rounds"])


@query
def profit_grid(star: Star) -> DataFrame:
    return jobs.profit_grid(star)


@query
def ship_mode_scores(star: Star) -> DataFrame:
    """Train and test scores, with the rounds run and the best one, up to which trees are kept."""
    results = jobs.ship_mode_model(star)
    rounds = {row["metric"]: F.lit(int(row["value"])) for row in results["rounds"].collect()}
    part = lambda name: results[f"scores_{name}"].withColumn("part", F.lit(name)).withColumns(rounds)
    return part("train").unionByName(part("test"))


@query
def ship_mode_metadata(star: Star) -> DataFrame:
    row = jobs.ship_mode_model(star)["metadata"]
    return row.select(*[F.to_json(c).alias(c) for c in row.columns])


@query
def ship_mode_importances(star: Star) -> DataFrame:
    return jobs.ship_mode_model(star)["importances"]


@query
def ship_mode_balanced_scores(star: Star) -> DataFrame:
    """Deeper trees on training rows balanced by synthetic rows."""
    return jobs.ship_mode_model(star, rounds=1900, depth=7, rate=0.04, balance=True)["scores_test"]


@query
def ship_mode_rounds(star: Star) -> DataFrame:
    return jobs.ship_mode_rounds(star)
