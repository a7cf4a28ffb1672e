"""Exact order statistics without a global sort: quantiles, running totals, exact-size selection."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tallyloom.functions.columns import row_hash
from tallyloom.session import broadcast_staged, checked_broadcast, stage

# Rows of distinct values one window task may sort.
ROWS_PER_WINDOW = 200_000
# A row hash has 32 bits; its leading bits make the selection histogram.
HASH_TAIL_BITS = 16


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float] | dict[str, Sequence[float]],
    by: str | None = None,
    interpolation: str = "linear",
    accuracy: int = 10_000,
    margin: float | None = None,
) -> DataFrame:
    """Exact quantiles as rows ([by,] column, prob, n, value). Nulls are ignored.

    ``probs`` is one list for all columns or a list per column.

    No pass shuffles or sorts the data. First the mergeable quantile sketch of
    ``percentile_approx``, whose rank error is at most n / accuracy, yields for
    each quantile two values that must enclose it. Then the values below and in each
    bracket are counted in one pass (if one misses its ranks, wider ones are tried), and the distinct values inside it, about 4n / accuracy
    rows at most, are gathered with their counts and ranked exactly. Raise
    ``accuracy`` with n to keep the brackets small.

    ``interpolation`` is ``linear`` or ``midpoint``.
    """
    group = [by] if by else []
    wanted = probs if isinstance(probs, dict) else {c: probs for c in columns}
    slots = [(i, c, p) for i, (c, p) in enumerate((c, p) for c in columns for p in wanted[c])]
    margin = 2.0 / accuracy if margin is None else margin
    base = df.select(*group, *[F.col(c).cast("double").alias(c) for c in columns])

    stats: list[Column] = []
    for c in columns:
        stats += [F.count(c).alias(f"n_{c}"), F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
        asked = [F.lit(min(max(q, 0.0), 1.0)) for p in wanted[c] for q in (p - margin, p + margin)]
        stats.append(F.percentile_approx(c, F.array(*asked), F.lit(accuracy)).alias(f"q_{c}"))
    brackets = []
    for i, c, p in slots:
        at = 2 * list(wanted[c]).index(p)
        # With few rows the bracket is the whole range; so it is at an end of the range.
        few = F.col(f"n_{c}") <= 4 * accuracy
        low = F.when(few | F.lit(p <= margin), F.col(f"min_{c}")).otherwise(F.col(f"q_{c}")[at])
        high = F.when(few | F.lit(p >= 1 - margin), F.col(f"max_{c}")).otherwise(F.col(f"q_{c}")[at + 1])
        brackets += [low.alias(f"low_{i}"), high.alias(f"high_{i}"), F.col(f"n_{c}").alias(f"n_{i}")]
    # Staged: every later step must see the same brackets.
    found = stage(base.groupBy(*group).agg(*stats).select(*group, *brackets))

    if by:
        rows = base.join(broadcast_staged(found), by)
        edge = F.col
    else:
        literals = found.first().asDict()
        rows = base
        edge = lambda name: F.lit(literals[name])
    value = {i: F.col(c) for i, c, _ in slots}
    inside = {i: value[i].between(edge(f"low_{i}"), edge(f"high_{i}")) for i, _, _ in slots}

    below = rows.groupBy(*group).agg(
        *[F.count(F.when(value[i] < edge(f"low_{i}"), 1)).alias(f"below_{i}") for i, _, _ in slots],
        *[F.count(F.when(inside[i], 1)).alias(f"inside_{i}") for i, _, _ in slots],
    )
    # A bracket that doesn't hold the wanted ranks is found out here and widened.
    below = stage(found.join(below, by)) if by else stage(below.withColumns({f"n_{i}": F.lit(literals[f"n_{i}"]) for i, _, _ in slots}))
    missed = F.lit(False)
    for i, _, p in slots:
        position = (F.col(f"n_{i}") - 1) * p
        holds = (F.col(f"below_{i}") <= F.floor(position)) & (F.ceil(position) < F.col(f"below_{i}") + F.col(f"inside_{i}"))
        missed = missed | (~holds & (F.col(f"n_{i}") > 0))
    if margin < 1 and not below.where(missed).isEmpty():
        # From 0 on as well, so that a bracket that misses always grows.
        return exact_quantiles(df, columns, probs, by, interpolation, accuracy, max(8 * margin, 2 / accuracy))
    any_inside = inside[0]
    for i in list(inside)[1:]:
        any_inside = any_inside | inside[i]
    cells = F.array(*[F.when(inside[i], F.struct(F.lit(i).alias("slot"), value[i].alias("value"))) for i in inside])
    counts = (
        rows.filter(any_inside)
        .select(*group, F.inline(F.array_compact(cells)))
        .groupBy(*group, "slot", "value")
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    described = below
    targets = described.select(
        *group,
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(i).alias("slot"), F.lit(c).alias("column"), F.lit(p).alias("prob"),
                        F.col(f"n_{i}").alias("n"), F.col(f"below_{i}").alias("below"),
                    )
                    for i, c, p in slots
                ]
            )
        ),
    )
    ordered = W.partitionBy(*group, "slot").orderBy("value")
    position = (F.col("n") - 1) * F.col("prob")
    reached = lambda rank: F.min(F.when(F.col("_upto") > rank, F.col("value")))
    hits = (
        counts.withColumn("_upto", F.sum("_c").over(ordered))
        .join(targets, [*group, "slot"])
        .withColumn("_upto", F.col("_upto") + F.col("below"))
        .groupBy(*group, "column", "prob", "n")
        .agg(reached(F.floor(position)).alias("lower"), reached(F.ceil(position)).alias("upper"))
    )
    weight = position - F.floor(position) if interpolation == "linear" else F.lit(0.5)
    return hits.select(
        *group, "column", "prob", "n", (F.col("lower") + weight * (F.col("upper") - F.col("lower"))).alias("value")
    )


def quantile_values(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float] | dict[str, Sequence[float]], **options
) -> dict:
    """Exact quantiles as {(column, prob): value}; one entry per column and probability."""
    rows = exact_quantiles(df, columns, probs, **options).collect()
    return {(r["column"], r["prob"]): r["value"] for r in rows}


def indicator_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> dict:
    """Exact quantiles of 0/1 columns as {(column, prob): value}, from the number of ones; one pass."""
    ones = df.agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in columns]).first()
    n = ones["n"]
    at = lambda c, rank: 1.0 if rank >= n - ones[c] else 0.0
    found = {}
    for c in columns if n else []:
        for p in probs:
            position = (n - 1) * p
            low, high = at(c, math.floor(position)), at(c, math.ceil(position))
            found[c, p] = low + (position - math.floor(position)) * (high - low)
    return found


def running_totals(
    counted: DataFrame, value: str, counts: Sequence[str], rows_per_window: int = ROWS_PER_WINDOW
) -> DataFrame:
    """Add ``before_<c>``: the sum of ``c`` over all rows with a smaller ``value``.

    ``counted`` has one row per distinct value, so hot values are single rows.
    The values are cut into ranges of about ``rows_per_window`` rows at
    approximate quantiles; range totals give each range its offset and a window
    inside the range does the rest, so no task sorts more than one range.
    """
    staged = stage(counted)
    ranges = math.ceil(staged.count() / rows_per_window)
    if ranges <= 1:
        staged = staged.withColumn("_range", F.lit(0.0))
    else:
        probs = [i / ranges for i in range(1, ranges)]
        inner = sorted(set(staged.approxQuantile(value, probs, 0.25 / ranges)))
        cutter = Bucketizer(
            splits=[-math.inf, *inner, math.inf], inputCol="_value", outputCol="_range", handleInvalid="error"
        )
        staged = cutter.transform(staged.withColumn("_value", F.col(value).cast("double"))).drop("_value")
    over_ranges = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        staged.groupBy("_range")
        .agg(*[F.sum(c).alias(f"_total_{c}") for c in counts])
        .select("_range", *[F.coalesce(F.sum(f"_total_{c}").over(over_ranges), F.lit(0)).alias(f"_off_{c}") for c in counts])
    )
    in_range = W.partitionBy("_range").orderBy(value).rowsBetween(W.unboundedPreceding, -1)
    return (
        staged.join(offsets, "_range")
        .withColumns(
            {
                f"before_{c}": F.col(f"_off_{c}") + F.coalesce(F.sum(c).over(in_range), F.lit(0))
                for c in counts
            }
        )
        .drop("_range", *[f"_off_{c}" for c in counts])
    )


def hash_limits(
    df: DataFrame, row_id: str, fraction: float | None = None, size: int | None = None,
    by: str | None = None, salt: str = "",
) -> DataFrame:
    """The largest (hash, row id) still inside an exact share or number of rows, per group.

    Rows are ordered by a hash of their id. A histogram over the hash's leading
    bits finds the one bucket in which the wanted row lies; only that bucket's
    rows, a 65,536th of the data, are ranked. Columns: [by,] bucket, last_hash, last_id;
    ``bucket`` is null when every row is inside.
    """
    group = [by] if by else []
    keys = df.select(*group, row_hash(F.col(row_id), salt).alias("_h"), F.col(row_id).cast("string").alias("_id"))
    keys = keys.withColumn("bucket", F.shiftright("_h", HASH_TAIL_BITS))
    histogram = keys.groupBy(*group, "bucket").agg(F.count(F.lit(1)).alias("_c"))
    # At most 65,536 rows per group take part in these windows.
    whole = W.partitionBy(*group)
    upto = whole.orderBy("bucket")
    total = F.sum("_c").over(whole)
    wanted = F.floor(F.lit(fraction) * total) if size is None else F.least(F.lit(size), total)
    cut = (
        histogram.withColumns({"_upto": F.sum("_c").over(upto), "_wanted": wanted})
        .withColumn("_before", F.col("_upto") - F.col("_c"))
        .groupBy(*group)
        .agg(
            F.min(F.when(F.col("_upto") > F.col("_wanted"), F.col("bucket"))).alias("bucket"),
            F.min(F.when(F.col("_upto") > F.col("_wanted"), F.struct("bucket", (F.col("_wanted") - F.col("_before")).alias("_need")))).alias("_s"),
        )
        .select(*group, "bucket", F.col("_s._need").alias("_need"))
    )
    cut = checked_broadcast(cut)
    ranked = W.partitionBy(*group, "bucket").orderBy("_h", "_id")
    last = (
        keys.join(cut, [*group, "bucket"])
        .withColumn("_r", F.row_number().over(ranked))
        .filter(F.col("_r") == F.col("_need"))
        .select(*group, "bucket", F.col("_h").alias("last_hash"), F.col("_id").alias("last_id"))
    )
    return cut.select(*group, "bucket").join(last.drop("bucket") if by else last, group or ["bucket"], "left")


def inside_limits(row_id: str, bucket: Column, last_hash: Column, last_id: Column, salt: str = "") -> Column:
    """True for the rows up to and including the limit found by :func:`hash_limits`."""
    h, own_id = row_hash(F.col(row_id), salt), F.col(row_id).cast("string")
    own_bucket = F.shiftright(h, HASH_TAIL_BITS)
    in_cut = (h < last_hash) | ((h == last_hash) & (own_id <= last_id))
    inside = bucket.isNull() | (own_bucket < bucket) | ((own_bucket == bucket) & in_cut)
    return F.coalesce(inside, F.lit(False))


def inside_first(df: DataFrame, row_id: str, salt: str = "", **wanted) -> Column:
    """Condition for exactly the wanted share or number of ``df``'s rows (one group)."""
    found = hash_limits(df, row_id, salt=salt, **wanted).first()
    bucket, last_hash, last_id = found if found else (None, None, None)
    return inside_limits(
        row_id, F.lit(bucket).cast("bigint"), F.lit(last_hash).cast("bigint"), F.lit(last_id).cast("string"), salt
    )


def mark_first(
    df: DataFrame, row_id: str, name: str, fraction: float | None = None, size: int | None = None,
    by: str | None = None, salt: str = "",
) -> DataFrame:
    """Add boolean ``name``: true for exactly the wanted share (or number) of rows, per group, by row hash."""
    if by is None:
        return df.withColumn(name, inside_first(df, row_id, salt, fraction=fraction, size=size))
    limits = hash_limits(df, row_id, fraction, size, by, salt)
    limits = checked_broadcast(limits.withColumnsRenamed({"bucket": "_bucket", "last_hash": "_hash", "last_id": "_id"}))
    inside = inside_limits(row_id, F.col("_bucket"), F.col("_hash"), F.col("_id"), salt)
    return df.join(limits, by).withColumn(name, inside).drop("_bucket", "_hash", "_id")
