"""Column expressions used by the feature frames. All stay inside generated JVM code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Quarter and weekday names by number (weekday 0 is Saturday).
QUARTER_NAMES = {1: "Q1", 2: "Q2", 3: "Q3", 4: "Q4"}
WEEKDAY_NAMES = {
    0: "Saturday", 1: "Sunday", 2: "Monday", 3: "Tuesday", 4: "Wednesday", 5: "Thursday", 6: "Friday",
}
# The bins of the sales and discount labels.
LABEL_EDGES = [0.0, 0.25, 0.5, 0.75, 1.0]
LABEL_NAMES = ["Low", "Potential Low", "Potential High", "High"]


def ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom``, null where ``bottom`` is zero."""
    return F.try_divide(top, bottom)


def guarded_ratio(top: Column, bottom: Column, epsilon: float = 1e-6) -> Column:
    """``top / (bottom + epsilon)``: finite when ``bottom`` is zero."""
    return F.try_divide(top, bottom + F.lit(epsilon))


def flag_above(value: Column, threshold: Column) -> Column:
    """1 where ``value`` exceeds ``threshold``, else 0; unknown counts as 0."""
    return F.coalesce((value > threshold).cast("int"), F.lit(0))


def cut(value: Column, edges: list[float], labels: list[str]) -> Column:
    """Label right-closed bins, the lowest edge included; null outside the edges."""
    if len(edges) != len(labels) + 1:
        raise ValueError("one more edge than labels is needed")
    chain = F.when(value < edges[0], F.lit(None).cast("string"))
    for upper, label in zip(edges[1:], labels):
        chain = chain.when(value <= upper, label)
    return chain


def map_values(value: Column, mapping: dict) -> Column:
    """Look ``value`` up in a small fixed mapping; null when it is not there."""
    chain = None
    for key, mapped in mapping.items():
        chain = (F if chain is None else chain).when(value == key, mapped)
    return chain


def first_largest(columns: list[str]) -> Column:
    """Name of the column holding the row's maximum; the first one on ties."""
    values = F.array(*[F.col(f"`{c}`") for c in columns])
    position = F.array_position(values, F.array_max(values))
    return F.element_at(F.array(*[F.lit(c) for c in columns]), position.cast("int"))


def parse_date_key(key: Column) -> Column:
    """A date from an integer yyyymmdd."""
    return F.to_date(key.cast("string"), "yyyyMMdd")


def parse_timestamp(text: Column) -> Column:
    """A timestamp without time zone from ``yyyy-MM-dd HH:mm:ss.SSS`` text."""
    return F.to_timestamp_ntz(text, F.lit("yyyy-MM-dd HH:mm:ss.SSS"))


def days_between(later: Column, earlier: Column) -> Column:
    """Whole days from ``earlier`` to ``later``: dates by difference."""
    return F.datediff(later, earlier)


def whole_days(later: Column, earlier: Column) -> Column:
    """Whole days between two timestamps without time zone, rounded down (also when negative)."""
    clock = lambda moment: moment - moment.cast("date").cast("timestamp_ntz")
    return F.datediff(later, earlier) - (clock(later) < clock(earlier)).cast("int")


def saturday_first_weekday(day: Column) -> Column:
    """Day of week with 0 for Saturday."""
    return (F.weekday(day) + 2) % 7


def cyclic(value: Column, period: int) -> tuple[Column, Column]:
    """Sine and cosine of a position in a cycle."""
    angle = F.lit(2.0) * F.pi() * value / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def row_hash(row_id: Column, salt: str = "") -> Column:
    """A repeatable number in [0, 2^32) from a row id, the same on any partitioning."""
    text = row_id.cast("string") if not salt else F.concat(F.lit(salt), row_id.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def unit_hash(row_id: Column, salt: str) -> Column:
    """A repeatable number in [0, 1) from a row id."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(salt), row_id), 11) / F.lit(float(1 << 53))


def columns_with_prefix(df: DataFrame, prefix: str) -> list[str]:
    """Columns of ``df`` whose names start with ``prefix``, in order."""
    return [c for c in df.columns if c.startswith(prefix)]


def scalar_of(df: DataFrame, **aggregates: Column) -> Column:
    """All-row aggregates of ``df`` as one struct-valued scalar subquery.

    Spark computes it once, from partial aggregates, and inlines the one row:
    there is no join and nothing to broadcast. Read a field with ``[name]``.
    """
    return df.agg(F.struct(*[a.alias(n) for n, a in aggregates.items()]).alias("s")).scalar()


def yeo_johnson(x: Column, power: Column) -> Column:
    """The Yeo-Johnson power transform."""
    other = F.lit(2.0) - power
    positive = F.when(F.abs(power) < 1e-12, F.log1p(x)).otherwise((F.pow(x + 1, power) - 1) / power)
    negative = F.when(F.abs(other) < 1e-12, -F.log1p(-x)).otherwise(-(F.pow(F.lit(1.0) - x, other) - 1) / other)
    return F.when(x >= 0, positive).otherwise(negative)
