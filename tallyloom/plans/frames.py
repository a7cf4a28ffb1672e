"""Feature frames: from the star schema to the tables the analyses use."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.columns import (
    LABEL_EDGES, LABEL_NAMES, columns_with_prefix, cut, cyclic, days_between, flag_above, guarded_ratio,
    parse_date_key, ratio, row_hash, scalar_of,
)
from tallyloom.operators.aggregates import pivot_counts, sums_by
from tallyloom.operators.encoding import dummies, fit_level_sums, fit_levels, group_statistic, level_values
from tallyloom.operators.order_statistics import exact_quantiles, quantile_values
from tallyloom.operators.splits import chronological_split, hash_split
from tallyloom.session import checked_broadcast, stage, stage_compact
from tallyloom.sources.star import DIMENSIONS, MEASURES, Star, denormalise, with_dates

ORDER_NUMBERS = ["sales", "quantity", "discount", "profit", "shipping_cost", "time_difference"]
ORDER_CATEGORIES = [
    "segment", "ship_mode_name", "category", "priority_name", "region", "order_day_of_week", "ship_day_of_week",
]
LOGGED = ["sales", "shipping_cost"]
DUMMY_PREFIXES = {
    "priority_name": "priority", "sub_category": "sub_cat", "ship_mode_name": "smn", "market": "market",
    "segment": "segment", "country_grouped": "country",
}
OPTIONAL_DUMMY_PREFIXES = {"region": "region", "quarter": "quarter", "day_of_week": "day"}
SHIP_MODE_CATEGORIES = [
    "priority_name", "market", "segment", "city", "state", "region", "year", "month", "day", "day_of_week",
    "sales_label", "discount_label",
]
SHIP_MODE_NUMBERS = ["sales", "quantity", "discount", "profit", "profit_margin", "sales_per_unit"]


def row_hash_percent(salt: str) -> F.Column:
    """A repeatable number from 0 to 99 per row."""
    return row_hash(F.col("row_id"), salt) % 100


def discount_groups(star: Star) -> DataFrame:
    """Order lines labelled ``Discounted`` or ``No Discount``; unknown or negative discounts are in neither."""
    lines = star.lines.select("row_id", "quantity", "discount").filter(F.col("discount") >= 0)
    return lines.withColumn("discount_type", F.when(F.col("discount") > 0, "Discounted").otherwise("No Discount"))


def customer_features(
    star: Star, years: Sequence[int], skip: Iterable[str] = (), measures: Sequence[str] = MEASURES
) -> DataFrame:
    """One row per customer: sums of the measures and order lines per year, over lines not returned.

    Lines are summed per order before they meet the orders, then per customer
    key before they meet the customer table: partial sums travel, not lines, and
    a hot order or customer is folded on the map side. ``skip`` names dimensions
    whose join may be left out (see :func:`denormalise`).
    """
    dims = [d for d in DIMENSIONS if d not in set(skip)]
    if star.headers is None:
        wide = denormalise(star, dims, order_dates=True).filter("is_returned = 0")
        per_key = _customer_sums(wide, "customer_id", years, measures)
        return per_key
    lines = star.lines.filter("is_returned = 0")
    for dim in ("product", "ship_mode"):
        if dim in dims:
            lines = lines.join(getattr(star, dim), f"{dim}_key")
    per_order = lines.groupBy("order_key").agg(
        *[F.sum(m).alias(m) for m in measures], F.count("row_id").alias("lines")
    )
    head = star.headers
    if star.locations is not None and {"geography", "market"} & set(dims):
        head = head.join(star.locations, "customer_key")
    for dim, key in (("priority", "priority_key"), ("market", "market_key"), ("geography", "geo_key")):
        if dim in dims:
            head = head.join(getattr(star, dim), key)
    head = with_dates(star, head, "order").withColumnRenamed("order_year", "year")
    per_key = (
        per_order.join(head.select("order_key", "customer_key", "year"), "order_key")
        .groupBy("customer_key")
        .agg(
            *[F.sum(m).alias(m) for m in measures],
            *[F.sum(F.when(F.col("year") == y, F.col("lines")).otherwise(0)).alias(f"year_{y}") for y in years],
        )
    )
    return (
        per_key.join(star.customer, "customer_key")
        .groupBy("customer_id")
        .agg(
            *[F.coalesce(F.sum(m), F.lit(0.0)).alias(m) for m in measures],
            *[F.sum(f"year_{y}").cast("double").alias(f"year_{y}") for y in years],
        )
    )


def _customer_sums(wide: DataFrame, key: str, years: Sequence[int], measures: Sequence[str]) -> DataFrame:
    """Sums and yearly counts from denormalised lines, in one grouped aggregate."""
    return wide.groupBy(key).agg(
        *[F.coalesce(F.sum(m), F.lit(0.0)).alias(m) for m in measures],
        *[F.count(F.when(F.col("order_year") == y, F.col("row_id"))).cast("double").alias(f"year_{y}") for y in years],
    )


def customer_metrics(star: Star) -> DataFrame:
    """Sums of the measures per customer, over lines not returned."""
    wide = denormalise(star, ["customer"]).filter("is_returned = 0")
    return sums_by(wide, "customer_id", MEASURES)


def customer_year_pivot(star: Star, years: Sequence[int]) -> DataFrame:
    """Order lines per customer and year, one column per year."""
    wide = denormalise(star, ["customer"], order_dates=True).filter("is_returned = 0")
    return pivot_counts(wide, "customer_id", "order_year", years, "row_id", "year_")


def order_features(star: Star) -> DataFrame:
    """Per order line: six numbers, seven categories, and whether it was returned."""
    wide = denormalise(star, DIMENSIONS, order_dates=True, ship_dates=True)
    lag = days_between(F.col("ship_date"), F.col("order_date"))
    return wide.withColumn("time_difference", lag).select("row_id", *ORDER_NUMBERS, *ORDER_CATEGORIES, "is_returned")


def regression_base(star: Star) -> DataFrame:
    """Columns the profit frame is made from: lines not returned, with their ship-date attributes."""
    wide = denormalise(star, DIMENSIONS, ship_dates=True).filter("is_returned = 0")
    return wide.select(
        "row_id", *MEASURES, "order_date_key", "ship_date_key", "priority_name", "sub_category", "ship_mode_name",
        "market", "country", "region", "segment", F.col("ship_year").alias("year"),
        F.col("ship_quarter").alias("quarter"), F.col("ship_day_of_week").alias("day_of_week"),
    )


def _grouped_countries(sums: dict, k: int) -> tuple[list[str], list[str]]:
    """The ``k`` most frequent countries, and the sorted levels once the rest are ``Other``."""
    ranked = sorted(sums["country"], key=lambda c: (-sums["country"][c][0], c))
    kept = ranked[:k]
    return kept, sorted({*kept, *(["Other"] if len(ranked) > k else [])})


def _with_dummies(base: DataFrame, sums: dict, top_countries: int) -> DataFrame:
    """Group the rarer countries and add the dummies of all six categories, from fitted levels."""
    kept, country_levels = _grouped_countries(sums, top_countries)
    grouped = F.when(F.col("country").isin(kept), F.col("country")).otherwise("Other")
    levels = {c: country_levels if c == "country_grouped" else sorted(sums[c]) for c in DUMMY_PREFIXES}
    return dummies(base.withColumn("country_grouped", grouped), levels, DUMMY_PREFIXES)


def _merged_first(sums: dict[str, tuple], merge: bool) -> dict[str, tuple]:
    """Sums per level, the first two levels taken together if ``merge``."""
    if not merge or len(sums) < 2:
        return sums
    first, second = sorted(sums)[:2]
    both = tuple(a + b for a, b in zip(sums[first], sums[second]))
    return {**sums, first: both, second: both}


REGRESSION_CATEGORIES = ["priority_name", "sub_category", "ship_mode_name", "market", "segment", "country"]


def regression_frame(
    star: Star, merge_first_level: bool = False, train_fraction: float | None = None, top_countries: int = 10
) -> DataFrame:
    """The numeric frame for predicting profit.

    Encodes the mean sales of each sub-category over the whole frame. With
    ``train_fraction`` the rows are cut by order date, marked ``is_train``, and levels,
    frequent countries and means are those of the training rows. ``merge_first_level`` gives the first two
    sub-categories one mean, as reading the level back from dummies without a first
    level does. One pass fits levels, frequent countries and means; the rows are
    then made without a further shuffle.
    """
    base = fitted = regression_base(star)
    if train_fraction is not None:
        base = chronological_split(stage(base), "row_id", "order_date_key", train_fraction)
        fitted = base.filter("is_train")
    sums = fit_level_sums(fitted, REGRESSION_CATEGORIES, "sales")
    per_level = _merged_first(sums["sub_category"], merge_first_level)
    mean = level_values("sub_category", {v: total / m for v, (_, m, total) in per_level.items() if m})
    order_date = parse_date_key(F.col("order_date_key"))
    return (
        _with_dummies(base, sums, top_countries)
        .withColumns(
            {
                "price_per_unit": ratio(F.col("sales"), F.col("quantity")),
                "discount_amount": F.col("sales") * F.col("discount"),
                "order_month": F.month(order_date),
                "powered_discount": F.col("discount") * F.col("discount"),
                "mean_sale_of_each_sub_cat": mean,
            }
        )
        .withColumn("mean_sub_cat_sale_powered", F.col("mean_sale_of_each_sub_cat") * F.col("mean_sale_of_each_sub_cat"))
        .drop(
            "market_US", "market_EMEA", "smn_Second Class", "shipping_cost", "segment", "market", "ship_mode_name",
            "sub_category", "year", "priority_name", "country_grouped", "country", "region", "day_of_week",
            "quarter", "ship_date_key",
        )
    )


def regression_frame_thresholds(star: Star, merge_first_level: bool = False, train_percent: int | None = None) -> DataFrame:
    """The earlier profit frame: years since the first, threshold flags, market sales totals.

    With ``train_percent`` rows are marked ``is_train`` by their hash, and everything is
    fitted on those.
    """
    # Written once, so that the passes that fit and the one that makes the rows don't join the lines again.
    base = fitted = stage_compact(regression_base(star).drop("region", "quarter", "day_of_week"))
    if train_percent is not None:
        base = hash_split(base, "row_id", train_percent)
        fitted = base.filter("is_train")
    sums = fit_level_sums(fitted, REGRESSION_CATEGORIES, "sales")
    per_level = _merged_first(sums["market"], merge_first_level)
    first = scalar_of(fitted, year=F.min("year"))["year"]
    limits = quantile_values(fitted, ["sales", "discount"], {"sales": [0.6], "discount": [0.65]})
    return (
        _with_dummies(base, sums, 10)
        .withColumns(
            {
                "years_since_start": F.col("year") - first,
                "is_high_value_order": flag_above(F.col("sales"), F.lit(limits["sales", 0.6])),
                "is_high_discount": flag_above(F.col("discount"), F.lit(limits["discount", 0.65])),
                "powered_discount": F.col("discount") * F.col("discount"),
                "sum_sale_of_each_market": level_values("market", {v: total for v, (_, _, total) in per_level.items()}),
            }
        )
        .drop(
            "market_US", "market_EMEA", "smn_Second Class", "discount", "priority_name", "sub_category",
            "ship_mode_name", "market", "segment", "country", "country_grouped", "year", "order_date_key", "ship_date_key",
        )
    )


def ship_mode_frame(star: Star, floor_one: bool = True) -> DataFrame:
    """Per order line: amounts, categories, ratios and bin labels, with the ship mode to predict.

    Sales and discount are binned as shares of their maximum, which is at least 1
    unless ``floor_one`` is off. Both maxima come from one aggregate of the fact.
    """
    wide = denormalise(star, ["ship_mode", "priority", "market", "customer", "geography"], order_dates=True)
    top = scalar_of(wide, sales=F.max("sales"), discount=F.max("discount"))
    share = lambda c: F.col(c) / (F.greatest(top[c], F.lit(1.0)) if floor_one else top[c])
    return wide.select(
        "row_id", "sales", "quantity", "discount", "profit", "priority_name", "market", "segment", "city", "state",
        "region", F.col("order_year").alias("year"), F.col("order_month").alias("month"), F.col("order_day").alias("day"),
        F.col("order_day_of_week").alias("day_of_week"), "ship_mode_name",
        guarded_ratio(F.col("profit"), F.col("sales")).alias("profit_margin"),
        guarded_ratio(F.col("sales"), F.col("quantity")).alias("sales_per_unit"),
        cut(share("sales"), LABEL_EDGES, LABEL_NAMES).alias("sales_label"),
        cut(share("discount"), LABEL_EDGES, LABEL_NAMES).alias("discount_label"),
    )


def ship_mode_frame_plain(star: Star) -> DataFrame:
    """The short form of the ship-mode frame: eleven raw features, no ratios or bins."""
    wide = denormalise(star, ["ship_mode", "priority", "market", "customer", "geography"], order_dates=True)
    return wide.select(
        "row_id", "sales", "profit", "priority_name", "market", "segment", "city", "state",
        F.col("order_year").alias("year"), F.col("order_month").alias("month"), F.col("order_day").alias("day"),
        F.col("order_day_of_week").alias("day_of_week"), "ship_mode_name",
    )


def optional_date_features(star: Star) -> DataFrame:
    """Shipping lag, weekend flag, weekday, ISO week, and the place of the order date in its range."""
    wide = denormalise(star, [], order_dates=True, ship_dates=True).filter("is_returned = 0")
    span = scalar_of(wide, first=F.min("order_date"), last=F.max("order_date"))
    day = F.col("order_date")
    return wide.select(
        "row_id",
        days_between(F.col("ship_date"), day).alias("shipping_lag_days"),
        (F.weekday(day) >= 5).cast("int").alias("is_weekend_order"),
        F.weekday(day).alias("order_day_of_week"),
        F.weekofyear(day).alias("order_week_of_year"),
        F.try_divide(
            days_between(day, span["first"]).cast("double"), days_between(span["last"], span["first"]).cast("double")
        ).alias("normalized_time_index"),
    )


def optional_amount_features(star: Star) -> DataFrame:
    """Clipped ``log1p`` of the amounts, and month and weekday as points on a circle."""
    wide = denormalise(star, [], order_dates=True)
    month_sin, month_cos = cyclic(F.col("order_month"), 12)
    day_sin, day_cos = cyclic(F.col("order_day_of_week"), 7)
    return wide.select(
        "row_id",
        F.log1p(F.greatest(F.col("sales"), F.lit(0.0))).alias("log_sales"),
        F.log1p(F.greatest(F.col("profit"), F.lit(0.0))).alias("log_profit"),
        month_sin.alias("month_sin"), month_cos.alias("month_cos"), day_sin.alias("day_sin"), day_cos.alias("day_cos"),
    )


def threshold_flags(star: Star) -> DataFrame:
    """Flags for sales, quantity and discount above their 0.6, 0.8 and 0.65 quantiles."""
    lines = star.lines.filter("is_returned = 0")
    probs = {"sales": [0.6], "quantity": [0.8], "discount": [0.65]}
    limits = quantile_values(lines, list(probs), probs)
    return lines.select(
        "row_id",
        flag_above(F.col("sales"), F.lit(limits["sales", 0.6])).alias("is_high_value_order"),
        flag_above(F.col("quantity"), F.lit(limits["quantity", 0.8])).alias("is_high_quantity_order"),
        flag_above(F.col("discount"), F.lit(limits["discount", 0.65])).alias("is_high_discount"),
    )


def market_median_sales(star: Star) -> DataFrame:
    """Median sales of the row's market on every line not returned."""
    wide = denormalise(star, ["market"]).filter("is_returned = 0").select("row_id", "market", "sales")
    median = exact_quantiles(wide, ["sales"], [0.5], by="market").select("market", F.col("value").alias("median_sale_of_each_market"))
    return wide.join(checked_broadcast(median), "market", "left").drop("sales")


def country_frequency(star: Star) -> DataFrame:
    """Number of lines of the row's country on every line."""
    wide = denormalise(star, ["geography"]).select("row_id", "country")
    return group_statistic(wide, "country", F.count(F.lit(1)), "country_freq_encoded")


def optional_dummies(star: Star) -> DataFrame:
    """Dummies for region, quarter and weekday."""
    base = regression_base(star).withColumns({c: F.col(c).cast("string") for c in OPTIONAL_DUMMY_PREFIXES})
    levels = fit_levels(base, list(OPTIONAL_DUMMY_PREFIXES))
    frame = dummies(base, levels, OPTIONAL_DUMMY_PREFIXES)
    names = [c for p in OPTIONAL_DUMMY_PREFIXES.values() for c in columns_with_prefix(frame, f"{p}_") if c != "day_of_week"]
    return frame.select("row_id", *[F.col(f"`{c}`") for c in names])


def staged_customer_features(star: Star, years: Sequence[int]) -> DataFrame:
    """Customer features written once to the checkpoint folder, for the iterations that follow."""
    return stage(customer_features(star, years))


def order_years(star: Star) -> list[int]:
    """The years in which orders were placed, from the order keys alone."""
    keys = (star.lines if star.headers is None else star.headers).select("order_date_key").where("order_date_key IS NOT NULL")
    years = keys.select(F.floor(F.col("order_date_key") / 10000).cast("int").alias("year")).distinct().collect()
    return sorted(r["year"] for r in years)
