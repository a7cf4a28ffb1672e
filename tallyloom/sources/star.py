"""The sales star schema: one fact and seven dimensions, from CSV or Parquet."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, fields

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The small dimensions of the sales model.
SHIP_MODES = [("Same Day", 1), ("Second Class", 2), ("First Class", 3), ("Standard Class", 4)]
# The order priorities of the order table, keyed by their leading digit.
PRIORITIES = [("1-URGENT", 1), ("2-HIGH", 2), ("3-MEDIUM", 3), ("4-NOT SPECIFIED", 4), ("5-LOW", 5)]

MEASURES = ["sales", "quantity", "discount", "profit", "shipping_cost"]
DIMENSIONS = ["customer", "ship_mode", "product", "priority", "market", "geography"]
LINE_DIMENSIONS = {"product", "ship_mode"}

_INT, _DBL, _STR = T.LongType(), T.DoubleType(), T.StringType()
# Columns of the CSV files, with the header names the sales model uses.
CSV_SCHEMAS: dict[str, list[tuple[str, T.DataType]]] = {
    "Fact_Sales": [
        ("Row ID", _INT), ("Sales", _DBL), ("Quantity", _DBL), ("Discount", _DBL), ("Profit", _DBL),
        ("Shipping Cost", _DBL), ("Order Date Key", _INT), ("Ship Date Key", _INT), ("Product Key", _INT),
        ("Customer Key", _INT), ("Geo Key", _INT), ("Priority Key", _INT), ("Ship Mode Key", _INT),
        ("Market Key", _INT), ("Is Returned", T.IntegerType()),
    ],
    "Dim_Customer": [("Customer Key", _INT), ("Customer ID", _STR), ("Segment", _STR)],
    "Dim_Product": [("Product Key", _INT), ("Category", _STR), ("Sub Category", _STR)],
    "Dim_Geography": [("Geo Key", _INT), ("City", _STR), ("State", _STR), ("Country", _STR), ("Region", _STR)],
    "Dim_Market": [("Market", _STR), ("Market Key", _INT)],
    "Dim_Priority": [("Priority Name", _STR), ("Priority Key", _INT)],
    "Dim_Ship_Mode": [("Ship Mode Name", _STR), ("Ship Mode Key", _INT)],
    "Dim_Date": [
        ("Date Key", _INT), ("Date", _STR), ("Year", T.IntegerType()), ("Quarter", T.IntegerType()),
        ("Month", T.IntegerType()), ("Day", T.IntegerType()), ("Day of Week", T.IntegerType()),
    ],
}
# The order table, which a sales model may leave out; only its key is known by name, other columns are text.
ORDER_LOOKUP, ORDER_LOOKUP_COLUMNS = "Dim_Order_Lookup", [("Order Key", _INT)]
# Columns used of the Parquet order tables.
TABLE_SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string",
    "part": "p_partkey bigint, p_brand string, p_type string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


@dataclass
class BareLines:
    """Lines with the columns that others are worked out from, and those others.

    They are narrower, so joins move them, and the others are worked out behind the joins. ``lines`` are the lines that they give.
    """

    lines: DataFrame
    bare: DataFrame
    worked_out: dict[str, F.Column]

    def whole(self, frame: DataFrame) -> DataFrame:
        """``frame``, which bare lines were joined into, with all columns of the lines in place of the bare ones."""
        others = [c for c in frame.columns if c not in set(self.bare.columns) | set(self.lines.columns)]
        return frame.select(*[self.worked_out[c].alias(c) if c in self.worked_out else c for c in self.lines.columns], *others)


@dataclass
class Star:
    """Frames of the star schema.

    ``lines`` holds one row per order line. Where the source keeps order-level
    keys in a table of their own, ``headers`` is that table (joined on
    ``order_key``) and ``locations`` gives a customer's geography and market
    keys; both are None when ``lines`` already carries every key. ``order_lookup`` is
    the order table of a source whose lines need nothing of it.
    """

    lines: DataFrame
    customer: DataFrame
    product: DataFrame
    geography: DataFrame
    market: DataFrame
    priority: DataFrame
    ship_mode: DataFrame
    date: DataFrame
    headers: DataFrame | None = None
    locations: DataFrame | None = None
    #: The source has no date table, so date columns are worked out from the keys and no date is left out.
    dates_from_keys: bool = False
    order_lookup: DataFrame | None = None
    #: The lines in fewer columns, for joins; heeded only while ``lines`` are those that they give.
    narrow: BareLines | None = None


NO_DIMENSIONS = ("lines", "headers", "locations", "dates_from_keys", "order_lookup", "narrow")


def snake(name: str) -> str:
    """``Ship Mode Name`` -> ``ship_mode_name``."""
    return name.strip().lower().replace(" ", "_")


def read_csv_table(spark: SparkSession, path: str, columns: list[tuple[str, T.DataType]]) -> DataFrame:
    """Read a CSV with a header under declared types; columns are found by header name.

    The header row is read as strings to learn the file's column order; the types
    never depend on the data.
    """
    types = dict(columns)
    others = dict(ORDER_LOOKUP_COLUMNS)
    header = spark.read.option("header", True).option("inferSchema", False).csv(path).columns
    missing = [name for name in types if name not in header]
    if missing:
        raise ValueError(f"{path} lacks the columns {missing}")
    schema = T.StructType([T.StructField(name, types.get(name, others.get(name, _STR))) for name in header])
    table = spark.read.option("header", True).option("mode", "FAILFAST").schema(schema).csv(path)
    return table.select(*[F.col(f"`{name}`").alias(snake(name)) for name in header])


def star_from_csv(spark: SparkSession, folder: str) -> Star:
    """The star from the eight CSV files ``Fact_Sales.csv``, ``Dim_*.csv`` in ``folder``, and ``Dim_Order_Lookup.csv`` if it is there."""
    tables = {
        name: read_csv_table(spark, f"{folder}/{name}.csv", columns) for name, columns in CSV_SCHEMAS.items()
    }
    dims = {snake(name.removeprefix("Dim_")): df for name, df in tables.items() if name.startswith("Dim_")}
    dims["date"] = dims["date"].withColumn("date", F.to_date(F.substring("date", 1, 10)))
    try:
        lookup = read_csv_table(spark, f"{folder}/{ORDER_LOOKUP}.csv", ORDER_LOOKUP_COLUMNS)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        lookup = None
    return Star(lines=tables["Fact_Sales"], order_lookup=lookup, **dims)


def star_from_views(spark: SparkSession) -> Star:
    """The star from tables or temp views named ``fact_sales`` and ``dim_*`` (see :func:`register_views`)."""
    dims = {
        f.name: spark.table(f"dim_{f.name}") for f in fields(Star) if f.name not in NO_DIMENSIONS
    }
    return Star(lines=spark.table("fact_sales"), **dims)


def register_views(star: Star) -> list[str]:
    """Register the star as temp views ``fact_sales`` and ``dim_*``; returns their names."""
    names = []
    for f in fields(Star):
        if f.name != "lines" and f.name in NO_DIMENSIONS:
            continue
        name = "fact_sales" if f.name == "lines" else f"dim_{f.name}"
        frame = fact_sales(star) if f.name == "lines" else getattr(star, f.name)
        frame.createOrReplaceTempView(name)
        names.append(name)
    return names


def date_parts(day) -> dict[str, F.Column]:
    """The columns of the date dimension for a date. ``day_of_week`` 0 is Saturday."""
    return {
        "date": day, "year": F.year(day), "quarter": F.quarter(day), "month": F.month(day), "day": F.dayofmonth(day),
        "day_of_week": (F.weekday(day) + 2) % 7,
    }


def calendar(*days: DataFrame) -> DataFrame:
    """A date dimension of every day from the first to the last in one-column frames of dates."""
    ends = [d.toDF("day").agg(F.min(F.to_date("day")).alias("first"), F.max(F.to_date("day")).alias("last")) for d in days]
    both = ends[0]
    for other in ends[1:]:
        both = both.unionByName(other)
    both = both.agg(F.min("first").alias("first"), F.max("last").alias("last")).where("first IS NOT NULL")
    day = both.select(F.explode(F.sequence("first", "last")).alias("_day"))
    return day.select(date_key(F.col("_day")).alias("date_key"), *[c.alias(n) for n, c in date_parts(F.col("_day")).items()])


def small_table(spark: SparkSession, rows: list[tuple[str, int]], name: str, key: str) -> DataFrame:
    """A literal name/key table, whose size the optimiser knows."""
    values = ", ".join(f"('{text}', {number}L)" for text, number in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({name}, {key})")


def date_key(day) -> F.Column:
    """Integer yyyymmdd of a date column, without going through a string."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("bigint")


def line_id() -> F.Column:
    """A line's id: its keys, its date and its price in cents, as the keys alone occur more than once."""
    cents = F.round(F.col("sales") * 100).cast("bigint")
    return F.concat_ws("-", "order_key", "product_key", "l_suppkey", "l_linenumber", "ship_date_key", cents)


def load_star(spark: SparkSession, folder: str) -> Star:
    """Map the order tables in ``folder`` (Parquet) onto the sales star.

    The schemas are declared, so nothing is read here; every frame is a lazy projection.
    """
    read = lambda name: spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")
    item, orders, customer = read("lineitem"), read("orders"), read("customer")
    nation, region, part = read("nation"), read("region"), read("part")

    bare = item.select(
        F.col("l_orderkey").alias("order_key"),
        F.col("l_partkey").alias("product_key"),
        (F.lit(1) + F.col("l_linenumber") % 4).cast("bigint").alias("ship_mode_key"),
        date_key("l_shipdate").alias("ship_date_key"),
        F.col("l_extendedprice").alias("sales"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_discount").alias("discount"),
        "l_suppkey", "l_linenumber", "l_tax",
        (F.col("l_returnflag") == "R").cast("int").alias("is_returned"),
    )
    worked_out = {
        "row_id": line_id(),
        "profit": F.col("sales") * (F.lit(0.25) - F.lit(3.0) * F.col("discount")),
        "shipping_cost": F.col("sales") * F.col("l_tax"),
    }
    columns = [
        "row_id", "order_key", "product_key", "ship_mode_key", "ship_date_key", "sales", "quantity", "discount", "profit", "shipping_cost",
        "is_returned",
    ]
    lines = bare.select(*[worked_out[c].alias(c) if c in worked_out else c for c in columns])
    headers = orders.select(
        F.col("o_orderkey").alias("order_key"),
        F.col("o_custkey").alias("customer_key"),
        F.substring("o_orderpriority", 1, 1).cast("bigint").alias("priority_key"),
        date_key("o_orderdate").alias("order_date_key"),
    )
    # A geography key is the nation and the remainder of the customer key by 97 * 13.
    places = 97 * 13
    locations = customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.col("c_custkey").alias("customer_key"),
        (F.col("c_nationkey").cast("bigint") * places + F.col("c_custkey") % places).alias("geo_key"),
        F.col("n_regionkey").cast("bigint").alias("market_key"),
    )
    geography = (
        nation.join(region, nation.n_regionkey == region.r_regionkey)
        .withColumn("place", F.explode(F.sequence(F.lit(0), F.lit(places - 1))))
        .select(
            (F.col("n_nationkey").cast("bigint") * places + F.col("place")).alias("geo_key"),
            F.concat(F.lit("CITY_"), (F.col("place") % 97).cast("string")).alias("city"),
            F.concat(F.lit("STATE_"), (F.col("place") % 13).cast("string")).alias("state"),
            F.col("n_name").alias("country"),
            F.col("r_name").alias("region"),
        )
    )
    return Star(
        lines=lines,
        headers=headers,
        locations=locations,
        customer=customer.select(
            F.col("c_custkey").alias("customer_key"),
            F.col("c_custkey").cast("string").alias("customer_id"),
            F.col("c_mktsegment").alias("segment"),
        ),
        product=part.select(
            F.col("p_partkey").alias("product_key"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("sub_category"),
        ),
        geography=geography,
        market=region.select(
            F.col("r_regionkey").cast("bigint").alias("market_key"), F.col("r_name").alias("market")
        ),
        priority=small_table(spark, PRIORITIES, "priority_name", "priority_key"),
        ship_mode=small_table(spark, SHIP_MODES, "ship_mode_name", "ship_mode_key"),
        date=calendar(orders.select("o_orderdate"), item.select("l_shipdate")),
        dates_from_keys=True,
        narrow=BareLines(lines, bare, worked_out),
    )


def _dimension_key(dimension: str) -> str:
    return "geo_key" if dimension == "geography" else f"{dimension}_key"


def with_dates(star: Star, frame: DataFrame, role: str) -> DataFrame:
    """``frame`` with the date dimension's columns under a role, ``order_*`` or ``ship_*``; rows without a known date go."""
    key = f"{role}_date_key"
    if star.dates_from_keys:
        # A key is yyyymmdd; the join with a complete calendar would keep the rows that have one.
        day = F.make_date(F.floor(F.col(key) / 10000).cast("int"), F.floor(F.col(key) / 100).cast("int") % 100, (F.col(key) % 100).cast("int"))
        return frame.where(F.col(key).isNotNull()).withColumns({f"{role}_{n}": c for n, c in date_parts(day).items()})
    return frame.join(star.date.select(*[F.col(c).alias(f"{role}_{c}") for c in star.date.columns]), key)


def denormalise(
    star: Star,
    dims: Iterable[str] = DIMENSIONS,
    order_dates: bool = False,
    ship_dates: bool = False,
    skip: Iterable[str] = (),
) -> DataFrame:
    """Inner-join the fact with the named dimensions.

    An inner join to a dimension that adds no column still drops orphan rows, so
    the joins stay in unless named in ``skip``; skip one only after
    :func:`star_integrity` shows its key unique and complete.

    Order-level dimensions are joined to the order headers first: those have
    fewer and narrower rows than the lines, which then move once, on the order
    key. The lines meet their own dimensions before that, so that the headers' columns
    are moved with them no second time, and carry the columns of ``star.narrow`` until all joins are done.
    No broadcast is hinted; Spark broadcasts a dimension when its measured
    size allows and otherwise shuffles both sides and splits skewed partitions.
    """
    wanted = [d for d in dims if d not in set(skip)]
    frame, head = star.lines, star.headers
    narrow = star.narrow if star.narrow is not None and star.narrow.lines is star.lines else None
    if head is not None:
        if narrow is not None:
            frame = narrow.bare
        for dim in wanted:
            if dim in LINE_DIMENSIONS:
                frame = frame.join(getattr(star, dim), _dimension_key(dim))
        if star.locations is not None and {"geography", "market"} & set(wanted):
            head = head.join(star.locations, "customer_key")
        for dim in wanted:
            if dim not in LINE_DIMENSIONS:
                head = head.join(getattr(star, dim), _dimension_key(dim))
        if order_dates:
            head = with_dates(star, head, "order")
        frame = frame.join(head, "order_key")
        if narrow is not None:
            frame = narrow.whole(frame)
        wanted = []
    for dim in wanted:
        frame = frame.join(getattr(star, dim), _dimension_key(dim))
    if order_dates and head is None:
        frame = with_dates(star, frame, "order")
    if ship_dates:
        frame = with_dates(star, frame, "ship")
    return frame


def fact_sales(star: Star) -> DataFrame:
    """The fact with all its keys, no dimension attributes."""
    if star.headers is None:
        return star.lines
    head = star.headers if star.locations is None else star.headers.join(star.locations, "customer_key")
    return star.lines.join(head, "order_key").drop("order_key")


def with_order_lookup(star: Star) -> DataFrame:
    """Lines joined to the order table on ``order_key``; of a column that both have, the lines' stays."""
    lookup = star.headers if star.headers is not None else star.order_lookup
    if lookup is None or "order_key" not in star.lines.columns:
        raise ValueError("the source has no order table, or its lines have no order key")
    added = [c for c in lookup.columns if c not in star.lines.columns]
    return star.lines.join(lookup.select("order_key", *added), "order_key")


def star_integrity(star: Star) -> DataFrame:
    """Per dimension: key values that occur more than once, and fact rows whose key is absent.

    Zero in both columns means the dimension's join neither drops nor multiplies
    rows. All fact keys are counted in one pass, before they are looked up, so a
    hot key is one row; the outer joins keep rows whose order or customer is missing.
    """
    fact = star.lines
    if star.headers is not None:
        head = star.headers
        if star.locations is not None:
            head = head.join(star.locations, "customer_key", "left")
        fact = fact.join(head, "order_key", "left")
    keys = [F.struct(F.lit(d).alias("dimension"), F.col(_dimension_key(d)).alias("key")) for d in DIMENSIONS]
    used = fact.select(F.inline(F.array(*keys))).groupBy("dimension", "key").agg(F.count(F.lit(1)).alias("fact_rows"))
    known = None
    for dim in DIMENSIONS:
        frame = getattr(star, dim).select(F.lit(dim).alias("dimension"), F.col(_dimension_key(dim)).alias("key"))
        known = frame if known is None else known.unionByName(frame)
    copies = known.groupBy("dimension", "key").agg(F.count(F.lit(1)).alias("copies"))
    missing = F.when(F.col("copies").isNull(), F.col("fact_rows"))
    return (
        used.join(copies, ["dimension", "key"], "full_outer")
        .groupBy("dimension")
        .agg(
            F.count(F.when(F.col("copies") > 1, 1)).alias("duplicate_keys"),
            F.coalesce(F.sum(missing), F.lit(0)).cast("bigint").alias("orphan_rows"),
        )
    )
