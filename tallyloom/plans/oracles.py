"""The same queries as plain SQL over the input tables, for checking."""

from __future__ import annotations

from tallyloom.functions import normal

ORACLES: dict[str, str] = {}

# The levels found in the input tables.
BRANDS = sorted(f"Brand#{i}" for i in range(1, 26))
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
SHIP_MODES = ["First Class", "Same Day", "Second Class", "Standard Class"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
YEARS = list(range(1995, 2002))
MEASURES = ["sales", "quantity", "discount", "profit", "shipping_cost"]


def _key(day: str) -> str:
    return f"(year({day}) * 10000 + month({day}) * 100 + day({day}))::BIGINT"


def _parts(role: str) -> str:
    day = f"{role}_date"
    return (
        f"year({day})::INT AS {role}_year, quarter({day})::INT AS {role}_quarter, month({day})::INT AS {role}_month, "
        f"day({day})::INT AS {role}_day, ((isodow({day}) + 1) % 7)::INT AS {role}_day_of_week"
    )


LINE = f"""line AS (
  SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber, {_key('l_shipdate')},
                   round(l_extendedprice * 100)::BIGINT) AS row_id, l_orderkey AS order_key,
         l_partkey AS product_key, 1 + l_linenumber % 4 AS ship_mode_key, l_shipdate::DATE AS ship_date,
         l_extendedprice AS sales, l_quantity AS quantity, l_discount AS discount,
         l_extendedprice * (0.25::DOUBLE - 3.0::DOUBLE * l_discount) AS profit,
         l_extendedprice * l_tax AS shipping_cost, (l_returnflag = 'R')::INT AS is_returned
  FROM lineitem)"""
WIDE = f"""{LINE}, joined AS (
  SELECT line.*, c_custkey::VARCHAR AS customer_id, c_custkey AS customer_key, c_mktsegment AS segment,
         'CITY_' || (c_custkey % 97) AS city, 'STATE_' || (c_custkey % 13) AS state, n_name AS country,
         r_name AS region, r_name AS market, r_regionkey::BIGINT AS market_key,
         n_nationkey::BIGINT * 1261 + c_custkey % 1261 AS geo_key, o_orderpriority AS priority_name,
         p_type AS category, p_brand AS sub_category, o_orderdate::DATE AS order_date,
         CASE ship_mode_key WHEN 1 THEN 'Same Day' WHEN 2 THEN 'Second Class'
              WHEN 3 THEN 'First Class' ELSE 'Standard Class' END AS ship_mode_name
  FROM line JOIN orders ON order_key = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  JOIN part ON product_key = p_partkey),
wide AS (SELECT *, {_parts('order')}, {_parts('ship')}, {_key('order_date')} AS order_date_key,
                {_key('ship_date')} AS ship_date_key FROM joined),
kept AS (SELECT * FROM wide WHERE is_returned = 0)"""
GROUPS = f"""{LINE}, grouped AS (
  SELECT row_id, quantity, discount, CASE WHEN discount > 0 THEN 'Discounted' ELSE 'No Discount' END AS discount_type
  FROM line WHERE discount >= 0)"""
HASH = "('0x' || substr(md5(row_id), 1, 8))::BIGINT"


def line(name: str, sql: str) -> None:
    ORACLES[name] = f"WITH {LINE} {sql}"


def wide(name: str, sql: str, more: str = "") -> None:
    ORACLES[name] = f"WITH {WIDE}{', ' + more if more else ''} {sql}"


def groups(name: str, sql: str) -> None:
    ORACLES[name] = f"WITH {GROUPS} {sql}"


def rounded(columns, digits: int, inner: str = "{c}") -> str:
    return ", ".join(f"round({inner.format(c=c)}, {digits}) AS {c}" for c in columns)


# Joins
wide("star_join", """SELECT row_id, sales, quantity, discount, profit, shipping_cost, customer_id, segment, category,
  sub_category, city, state, country, region, market, priority_name, ship_mode_name, is_returned FROM wide""")
wide("fact_keys", """SELECT row_id, order_date_key, ship_date_key, product_key, customer_key, geo_key,
  substr(priority_name, 1, 1)::BIGINT AS priority_key, ship_mode_key::BIGINT AS ship_mode_key, market_key FROM wide""")
ORACLES["star_key_integrity"] = """
WITH dims AS (
  SELECT 'customer' AS dimension, c_custkey AS k FROM customer
  UNION ALL SELECT 'product', p_partkey FROM part UNION ALL SELECT 'market', r_regionkey FROM region
  UNION ALL SELECT 'ship_mode', unnest([1, 2, 3, 4]) UNION ALL SELECT 'priority', unnest([1, 2, 3, 4, 5])
  UNION ALL SELECT 'geography', n_nationkey * 1261 + unnest(range(1261)) FROM nation),
facts AS (
  SELECT 'product' AS dimension, l_partkey AS k FROM lineitem
  UNION ALL SELECT 'ship_mode', 1 + l_linenumber % 4 FROM lineitem
  UNION ALL SELECT 'customer', o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  UNION ALL SELECT 'priority', substr(o_orderpriority, 1, 1)::BIGINT FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  UNION ALL SELECT 'geography', c_nationkey::BIGINT * 1261 + c_custkey % 1261
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  UNION ALL SELECT 'market', n_regionkey
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey),
copies AS (SELECT dimension, k, count(*) AS n FROM dims GROUP BY ALL)
SELECT d.dimension, d.duplicate_keys, coalesce(o.orphan_rows, 0)::BIGINT AS orphan_rows
FROM (SELECT dimension, count(*) FILTER (n > 1) AS duplicate_keys FROM copies GROUP BY 1) d
LEFT JOIN (SELECT f.dimension, count(*) AS orphan_rows FROM facts f
           WHERE NOT EXISTS (SELECT 1 FROM copies c WHERE c.dimension = f.dimension AND c.k = f.k) GROUP BY 1) o
ON d.dimension = o.dimension"""
wide("role_playing_dates", """SELECT row_id, order_year, order_quarter, order_month, order_day, order_day_of_week,
  ship_year, ship_quarter, ship_month, ship_day, ship_day_of_week, (ship_date - order_date)::INT AS time_difference FROM wide""")
line("non_returned_lines", "SELECT row_id, sales, quantity, discount, profit, shipping_cost FROM line WHERE is_returned = 0")
wide("sorted_by_order_date", "SELECT row_id, order_date_key FROM wide ORDER BY order_date_key, row_id")

# Customers
_sums = rounded(MEASURES, 4, "sum({c})")
_years = ", ".join(f"count(*) FILTER (order_year = {y})::DOUBLE AS year_{y}" for y in YEARS)
wide("customer_metrics", f"SELECT customer_id, {_sums} FROM kept GROUP BY 1")
wide("customer_year_pivot", f"SELECT customer_id, {_years} FROM kept GROUP BY 1")
wide("customer_features", f"SELECT customer_id, {_sums}, {_years} FROM kept GROUP BY 1")
ORACLES["customer_features_trusted_keys"] = ORACLES["customer_features"]
wide("lines_per_customer_year", "SELECT customer_id, order_year, count(row_id) AS orders_per_year FROM kept GROUP BY 1, 2")

# Discount groups
groups("discount_groups", "SELECT * FROM grouped")
ORACLES["discount_groups_stacked"] = ORACLES["discount_groups"]
groups("quantity_counts", "SELECT quantity, discount_type, count(*) AS order_count FROM grouped GROUP BY 1, 2")
groups("quantity_probability", """SELECT quantity, discount_type, count(*) AS order_count,
  count(*) / sum(count(*)) OVER (PARTITION BY discount_type)::DOUBLE AS probability FROM grouped GROUP BY 1, 2""")
groups("group_size", """SELECT discount_type, count(*) AS order_count,
  count(*) / sum(count(*)) OVER ()::DOUBLE AS group_percent FROM grouped GROUP BY 1""")
groups("group_moments", """SELECT discount_type, round(avg(quantity), 6) AS mean, median(quantity) AS median,
  round(stddev_samp(quantity), 6) AS std_dev FROM grouped GROUP BY 1""")

# Top-k grouping
wide("top_countries", "SELECT country, count(*) AS count FROM kept GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
_TOP = "top10 AS (SELECT country FROM kept GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 10)"
_GROUPED = "CASE WHEN country IN (SELECT country FROM top10) THEN country ELSE 'Other' END"
wide("country_grouped", f"SELECT row_id, country, {_GROUPED} AS country_grouped FROM kept", _TOP)

# Row expressions
line("price_features", """SELECT row_id, CASE WHEN quantity <> 0 THEN sales / quantity END AS price_per_unit,
  sales * discount AS discount_amount, discount * discount AS powered_discount FROM line""")
line("ship_mode_ratios", """SELECT row_id, profit / (sales + 1e-6::DOUBLE) AS profit_margin,
  sales / (quantity + 1e-6::DOUBLE) AS sales_per_unit FROM line""")


def _label(x: str) -> str:
    return (
        f"CASE WHEN {x} < 0 THEN NULL WHEN {x} <= 0.25::DOUBLE THEN 'Low' WHEN {x} <= 0.5::DOUBLE THEN 'Potential Low' "
        f"WHEN {x} <= 0.75::DOUBLE THEN 'Potential High' WHEN {x} <= 1 THEN 'High' END"
    )


_FLOORED = "greatest((SELECT max({c}) FROM {t}), 1.0::DOUBLE)"
_label_sales = _label(f"(sales / {_FLOORED.format(c='sales', t='line')})")
_label_discount = _label(f"(discount / {_FLOORED.format(c='discount', t='line')})")
line("sales_discount_labels", f"""SELECT row_id, {_label_sales} AS sales_label, {_label_discount} AS discount_label,
  {_label('(discount / (SELECT max(discount) FROM line))')} AS discount_label_no_floor FROM line""")
line("log_sales", """SELECT row_id, round(ln(sales), 9) AS log_sales, round(exp(ln(sales)), 4) AS sales_again,
  CASE WHEN shipping_cost > 0 THEN round(ln(shipping_cost), 9) END AS log_shipping_cost FROM line""")
wide("calendar_names", """SELECT row_id, 'Q' || ship_quarter AS quarter_name,
  ['Saturday','Sunday','Monday','Tuesday','Wednesday','Thursday','Friday'][ship_day_of_week + 1] AS weekday_name FROM wide""")
wide("years_since_start", "SELECT row_id, ship_year - min(ship_year) OVER () AS years_since_start FROM kept")
line("profit_above_minimum", "SELECT row_id, profit - (SELECT min(profit) FROM line) AS shifted_profit FROM line")

# Dates
ORACLES["date_parse"] = "SELECT o_orderkey AS order_key, strftime(o_orderdate, '%Y-%m-%d') AS order_date FROM orders"
ORACLES["order_month"] = "SELECT o_orderkey AS order_key, month(o_orderdate)::INT AS order_month FROM orders"
wide("ship_lag_days", "SELECT row_id, (ship_date - order_date)::INT AS shipping_lag_days FROM wide")


# Encoders
def _dummies(column: str, prefix: str, levels, first: int = 1) -> str:
    return ", ".join(f"""({column} = '{v}')::INT AS "{prefix}_{v}\"""" for v in levels[first:])


_brand = _dummies("sub_category", "sub_cat", BRANDS)
_segment = _dummies("segment", "segment", SEGMENTS)
wide("dummy_columns", f"SELECT row_id, {_brand}, {_segment} FROM wide")
wide("one_hot_columns", f"""SELECT row_id, {_dummies('segment', 'segment', SEGMENTS, 0)},
  {_dummies('ship_mode_name', 'ship_mode_name', SHIP_MODES, 0)} FROM wide""")
wide("label_codes", """SELECT row_id, (dense_rank() OVER (ORDER BY priority_name) - 1)::INT AS priority_name_code,
  (dense_rank() OVER (ORDER BY ship_mode_name) - 1)::INT AS ship_mode_name_code FROM wide""")
wide("sub_cat_mean_sales", """SELECT row_id, sub_category,
  round(avg(sales) OVER (PARTITION BY sub_category), 4) AS mean_sale_of_each_sub_cat FROM kept""")
wide("sub_cat_mean_sales_merged", """SELECT row_id, sub_category, merged,
  round(avg(sales) OVER (PARTITION BY merged), 4) AS mean_sale_of_each_sub_cat FROM m""",
  "m AS (SELECT *, CASE sub_category WHEN 'Brand#1' THEN 'Brand#10' ELSE sub_category END AS merged FROM kept)")
wide("market_sum_sales", """SELECT row_id, market,
  round(sum(sales) OVER (PARTITION BY market), 4) AS sum_sale_of_each_market FROM kept""")
wide("market_median_sales", """SELECT row_id, market,
  round(median(sales) OVER (PARTITION BY market), 6) AS median_sale_of_each_market FROM kept""")
wide("country_frequency", "SELECT row_id, country, count(*) OVER (PARTITION BY country) AS country_freq_encoded FROM wide")
line("threshold_flags", """, k AS (SELECT * FROM line WHERE is_returned = 0),
q AS (SELECT quantile_cont(sales, 0.6) AS s, quantile_cont(quantity, 0.8) AS q, quantile_cont(discount, 0.65) AS d FROM k)
SELECT row_id, (sales > s)::INT AS is_high_value_order, (quantity > q)::INT AS is_high_quantity_order,
  (discount > d)::INT AS is_high_discount FROM k, q""")
wide("optional_date_features", """SELECT row_id, (ship_date - order_date)::INT AS shipping_lag_days,
  (isodow(order_date) >= 6)::INT AS is_weekend_order, (isodow(order_date) - 1)::INT AS order_day_of_week,
  weekofyear(order_date)::INT AS order_week_of_year,
  (order_date - min(order_date) OVER ())::DOUBLE / (max(order_date) OVER () - min(order_date) OVER ())::DOUBLE
    AS normalized_time_index FROM kept""")
wide("optional_amount_features", """SELECT row_id, round(ln(1 + greatest(sales, 0)), 9) AS log_sales,
  round(ln(1 + greatest(profit, 0)), 9) AS log_profit,
  round(sin(2 * pi() * order_month / 12), 9) AS month_sin, round(cos(2 * pi() * order_month / 12), 9) AS month_cos,
  round(sin(2 * pi() * order_day_of_week / 7), 9) AS day_sin, round(cos(2 * pi() * order_day_of_week / 7), 9) AS day_cos
  FROM wide""")
wide("optional_dummies", f"""SELECT row_id, {_dummies('region', 'region', REGIONS)},
  {_dummies('ship_quarter', 'quarter', list('1234'))}, {_dummies('ship_day_of_week', 'day', list('0123456'))} FROM kept""")

# Feature frames
wide("order_features", """SELECT row_id, sales, quantity, discount, profit, shipping_cost,
  (ship_date - order_date)::INT AS time_difference, segment, ship_mode_name, category, priority_name, region,
  order_day_of_week, ship_day_of_week, is_returned FROM wide""")
_wl = _label(f"(sales / {_FLOORED.format(c='sales', t='wide')})")
_wd = _label(f"(discount / {_FLOORED.format(c='discount', t='wide')})")
wide("ship_mode_frame", f"""SELECT row_id, sales, quantity, discount, profit, priority_name, market, segment, city, state,
  region, order_year AS year, order_month AS month, order_day AS day, order_day_of_week AS day_of_week, ship_mode_name,
  profit / (sales + 1e-6::DOUBLE) AS profit_margin, sales / (quantity + 1e-6::DOUBLE) AS sales_per_unit,
  {_wl} AS sales_label, {_wd} AS discount_label FROM wide""")
wide("ship_mode_frame_plain", """SELECT row_id, sales, profit, priority_name, market, segment, city, state,
  order_year AS year, order_month AS month, order_day AS day, order_day_of_week AS day_of_week, ship_mode_name FROM wide""")
# The ten most frequent countries among the lines not returned of the sf0.01 tables.
COUNTRIES = [f"NATION_{i}" for i in (7, 11, 19, 2, 23, 3, 10, 13, 12, 21)]


_dummy_columns = ", ".join([
    _dummies("priority_name", "priority", PRIORITIES), _brand, _segment, _dummies("market", "market", REGIONS),
    # Second Class is left out by the frame, First Class as the first level.
    _dummies("ship_mode_name", "smn", [m for m in SHIP_MODES if m != "Second Class"]),
    _dummies("country_grouped", "country", sorted([*COUNTRIES, "Other"])),
])
_regrouped = f"{_TOP}, f AS (SELECT *, {_GROUPED} AS country_grouped FROM kept)"
wide("regression_frame", f"""SELECT row_id, sales, quantity, discount, profit, order_date_key,
  {_dummy_columns}, CASE WHEN quantity <> 0 THEN sales / quantity END AS price_per_unit,
  sales * discount AS discount_amount, order_month, discount * discount AS powered_discount,
  round(avg(sales) OVER (PARTITION BY sub_category), 4) AS mean_sale_of_each_sub_cat,
  round(avg(sales) OVER (PARTITION BY sub_category) * avg(sales) OVER (PARTITION BY sub_category), 1)
    AS mean_sub_cat_sale_powered FROM f""", _regrouped)
wide("regression_frame_thresholds", f"""SELECT row_id, sales, quantity, profit, shipping_cost, {_dummy_columns},
  ship_year - min(ship_year) OVER () AS years_since_start, (sales > s)::INT AS is_high_value_order,
  (discount > d)::INT AS is_high_discount, discount * discount AS powered_discount,
  round(sum(sales) OVER (PARTITION BY market), 4) AS sum_sale_of_each_market
  FROM f, (SELECT quantile_cont(sales, 0.6) AS s, quantile_cont(discount, 0.65) AS d FROM kept)""", _regrouped)

# Profiles
_seg = ", ".join(f'count(*) FILTER (segment = \'{s}\') AS "{s}"' for s in SEGMENTS)
wide("segment_crosstab", f"SELECT is_returned, {_seg} FROM wide GROUP BY 1")
wide("value_frequencies", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {c} AS value, count(*) AS count FROM wide GROUP BY 2"
    for c in ("segment", "ship_mode_name", "category", "priority_name", "region")))
wide("frequencies_by_return", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {c} AS value, is_returned AS hue, count(*) AS count FROM wide GROUP BY 2, 3"
    for c in ("segment", "ship_mode_name")))


def _corr(a: str, b: str, t: str) -> str:
    return f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, corr({a}, {b}) AS corr FROM {t}"


def _all_corr(columns, t: str) -> str:
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    return " UNION ALL ".join(_corr(a, b, t) for a, b in pairs)


line("correlation_matrix", f"SELECT feature_a, feature_b, round(corr, 6) AS corr FROM ({_all_corr(MEASURES, 'line')})")
_wider = [*MEASURES, "price_per_unit", "discount_amount", "powered_discount"]
line("high_correlations", f""", f AS (SELECT *, sales / quantity AS price_per_unit, sales * discount AS discount_amount,
  discount * discount AS powered_discount FROM line WHERE is_returned = 0),
c AS ({_all_corr(_wider, 'f')}),
t AS (SELECT CASE feature_a WHEN 'profit' THEN feature_b ELSE feature_a END AS f, abs(corr) * 100 AS p
      FROM c WHERE feature_a = 'profit' OR feature_b = 'profit')
SELECT feature_a, feature_b, round(abs(corr) * 100, 4) AS corr_percent, round(ta.p, 4) AS target_percent_a,
  round(tb.p, 4) AS target_percent_b
FROM c JOIN t ta ON ta.f = feature_a JOIN t tb ON tb.f = feature_b
WHERE feature_a <> feature_b AND abs(corr) * 100 > 50""")
line("measure_quantiles", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {p}::DOUBLE AS prob, count({c}) AS n, round(quantile_cont({c}, {p}), 6) AS value FROM line"
    for c in MEASURES for p in (0.25, 0.5, 0.75)))


def _box(columns, t: str, by: str = "") -> str:
    g = f"{by}, " if by else ""
    parts = []
    for c in columns:
        parts.append(f"""SELECT {g}'{c}' AS "column", round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
  min({c}) FILTER (inside) AS whisker_low, max({c}) FILTER (inside) AS whisker_high, count(*) FILTER (NOT inside) AS outliers
FROM (SELECT *, {c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM {t} JOIN
  (SELECT {g}quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS median, quantile_cont({c}, 0.75) AS q3
   FROM {t} {'GROUP BY ' + by if by else ''}) {f'USING ({by})' if by else 'ON TRUE'}) GROUP BY {g}q1, median, q3""")
    return " UNION ALL ".join(parts)


line("box_stats", _box(MEASURES, "line"))
wide("box_stats_by_ship_mode", _box(["sales", "profit"], "wide", "ship_mode_name"))


def _hist(c: str, log: bool, bins: int = 30) -> str:
    f = "ln({})" if log else "{}"
    back = "exp({})" if log else "{}"
    lo, hi = f"(SELECT {f.format(f'min({c})')} FROM line)", f"(SELECT {f.format(f'max({c})')} FROM line)"
    width = f"({hi} - {lo})"
    bin_no = f"least(floor(({f.format(c)} - {lo}) / {width} * {bins}), {bins - 1})::INT"
    low = back.format(f"{lo} + {width} * b.bin / {float(bins)}::DOUBLE")
    high = back.format(f"{lo} + {width} * (b.bin + 1) / {float(bins)}::DOUBLE")
    return f"""SELECT '{c}' AS "column", b.bin, round({low}, 6) AS low, round({high}, 6) AS high, {str(log).lower()} AS is_log,
  coalesce(h.n, 0)::BIGINT AS count FROM (SELECT unnest(range({bins}))::INT AS bin) b
  LEFT JOIN (SELECT {bin_no} AS bin, count(*) AS n FROM line GROUP BY 1) h ON h.bin = b.bin"""


line("histogram", " UNION ALL ".join(_hist(c, log) for c, log in (
    ("sales", True), ("quantity", True), ("discount", False), ("profit", False))))
line("kde_grid", """, s AS (SELECT min(sales) AS lo, max(sales) AS hi, stddev_samp(sales) AS sd, count(*) AS n FROM line),
p AS (SELECT *, sd * pow(n, -0.2) AS h FROM s),
b AS (SELECT least(floor((sales - lo) / (hi - lo) * 200), 199) AS bin, count(*) AS c FROM line, p GROUP BY 1),
g AS (SELECT unnest(range(100))::INT AS point),
x AS (SELECT point, lo - 3 * h + point * ((hi + 3 * h - (lo - 3 * h)) / 99) AS x, lo, hi, h, n FROM g, p)
SELECT point, round(x, 4) AS x,
  round(sum(c * exp(-0.5 * pow((x - (lo + (bin + 0.5) * ((hi - lo) / 200))) / h, 2))) / (n * h * 2.5066282746310002), 12) AS density
FROM x, b GROUP BY point, x, n, h""")
line("scatter_points", f"SELECT row_id, {', '.join(MEASURES)} FROM line")
line("profit_within_fences", """, k AS (SELECT row_id, profit FROM line WHERE is_returned = 0),
o AS (SELECT profit, row_number() OVER (ORDER BY profit) - 1 AS i, count(*) OVER () AS n FROM k),
q AS (SELECT (max(profit) FILTER (i = floor((n - 1) * 0.25)) + max(profit) FILTER (i = ceil((n - 1) * 0.25))) / 2 AS q1,
             (max(profit) FILTER (i = floor((n - 1) * 0.75)) + max(profit) FILTER (i = ceil((n - 1) * 0.75))) / 2 AS q3 FROM o)
SELECT row_id, profit FROM k, q WHERE profit BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)""")

# Scalers
line("robust_scale", f"""SELECT row_id, {', '.join(
    f'round(({c} - (SELECT quantile_cont({c}, 0.5) FROM line)) / (SELECT quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) FROM line), 8) AS {c}'
    for c in MEASURES)} FROM line""")
line("minmax_scale", f"""SELECT row_id, {', '.join(
    f'round(({c} - (SELECT min({c}) FROM line)) / (SELECT max({c}) - min({c}) FROM line), 8) AS {c}'
    for c in ('quantity', 'discount'))} FROM line""")
line("log_minmax_scale", """SELECT row_id, round((ln(sales) - (SELECT min(ln(sales)) FROM line))
  / (SELECT max(ln(sales)) - min(ln(sales)) FROM line), 8) AS sales FROM line""")
line("standard_scale", """SELECT row_id, round((profit - (SELECT avg(profit) FROM line))
  / (SELECT stddev_pop(profit) FROM line), 6) AS profit FROM line""")

# Splits
line("hash_split", f"SELECT row_id, {HASH} % 100 < 80 AS is_train FROM line")
_cut = "row_number() OVER (ORDER BY order_date_key, {h}, row_id) <= floor(0.85::DOUBLE * count(*) OVER ())"
wide("chrono_split", f"SELECT row_id, order_date_key, {_cut.format(h=HASH)} AS is_train FROM kept")
wide("chrono_split_validation", f"SELECT row_id, order_date_key, {_cut.format(h=HASH)} AS is_train FROM t",
     f"t AS (SELECT row_id, order_date_key FROM kept QUALIFY {_cut.format(h=HASH)})")
wide("stratified_split", f"""SELECT row_id, ship_mode_name, row_number() OVER (PARTITION BY ship_mode_name ORDER BY {HASH}, row_id)
  <= floor(0.75::DOUBLE * count(*) OVER (PARTITION BY ship_mode_name)) AS is_train FROM wide""")
groups("sample_per_group", f"""SELECT row_id, discount_type, quantity FROM grouped
  QUALIFY row_number() OVER (PARTITION BY discount_type ORDER BY {HASH}, row_id) <= 5000""")

# Hypothesis test
groups("average_ranks", """, v AS (SELECT quantity, count(*) AS t FROM grouped GROUP BY 1)
SELECT quantity, t, sum(t) OVER (ORDER BY quantity)::BIGINT - t + (t + 1) / 2.0::DOUBLE AS average_rank FROM v""")
groups("mann_whitney_u", """, r AS (SELECT quantity, discount_type, rank() OVER (ORDER BY quantity)
       + (count(*) OVER (PARTITION BY quantity) - 1) / 2.0::DOUBLE AS r FROM grouped),
t AS (SELECT sum(pow(n, 3) - n) AS ties FROM (SELECT count(*)::DOUBLE AS n FROM grouped GROUP BY quantity)),
s AS (SELECT count(*) FILTER (discount_type = 'Discounted') AS n1, count(*) FILTER (discount_type <> 'Discounted') AS n2,
      sum(r) FILTER (discount_type = 'Discounted') AS r1 FROM r),
u AS (SELECT n1, n2, r1 - n1::DOUBLE * (n1 + 1) / 2 AS u1, n1::DOUBLE * n2 AS p, (n1 + n2)::DOUBLE AS n, ties FROM s, t)
SELECT n1, n2, u1 AS u_statistic,
  round((greatest(u1, p - u1) - p / 2 - 0.5) / sqrt(p / 12 * ((n + 1) - ties / (n * (n - 1)))), 9) AS z FROM u""")


def _poly(x: str, coefficients) -> str:
    result = f"{coefficients[-1]!r}::DOUBLE"
    for c in reversed(coefficients[:-1]):
        result = f"({result} * {x} + {c!r}::DOUBLE)"
    return result


_QQ = f""", o AS (SELECT profit, row_number() OVER (ORDER BY profit) AS i, count(*) OVER ()::DOUBLE AS n FROM line),
p AS (SELECT profit, CASE WHEN i = n THEN pow(0.5, 1 / n) WHEN i = 1 THEN 1 - pow(0.5, 1 / n)
      ELSE (i - 0.3175::DOUBLE) / (n + 0.365::DOUBLE) END AS p FROM o),
d AS (SELECT *, p - 0.5::DOUBLE AS q, 0.180625::DOUBLE - (p - 0.5) * (p - 0.5) AS c,
      sqrt(-ln(least(p, 1 - p))) AS t FROM p),
z AS (SELECT profit AS ordered, CASE WHEN abs(q) <= 0.425 THEN q * {_poly('c', normal.CENTRAL_TOP)} / {_poly('c', normal.CENTRAL_BOTTOM)}
  WHEN t <= 5 THEN sign(q) * {_poly('(t - 1.6::DOUBLE)', normal.MIDDLE_TOP)} / {_poly('(t - 1.6::DOUBLE)', normal.MIDDLE_BOTTOM)}
  ELSE sign(q) * {_poly('(t - 5)', normal.FAR_TOP)} / {_poly('(t - 5)', normal.FAR_BOTTOM)} END AS theoretical FROM d)"""
line("qq_points", f"{_QQ} SELECT round(theoretical, 9) AS theoretical, ordered FROM z")
line("qq_line", f"""{_QQ} SELECT round(regr_slope(ordered, theoretical), 6) AS slope,
  round(regr_intercept(ordered, theoretical), 6) AS intercept, round(corr(ordered, theoretical), 6) AS r FROM z""")

line("yeo_johnson_values", """SELECT row_id, round(CASE WHEN profit >= 0 THEN (pow(profit / 1000.0::DOUBLE + 1, 0.75) - 1) / 0.75
  ELSE -(pow(1 - profit / 1000.0::DOUBLE, 1.25) - 1) / 1.25 END, 7) AS transformed FROM line""")

# Reports
line("global_aggregates", """, one AS (SELECT count(*)::DOUBLE AS "rows", max(sales) AS max_sales, min(sales) AS min_sales,
  round(avg(sales), 4) AS mean_sales, round(avg((discount > 0)::INT) * 100, 0) AS discounted_percent FROM line)
SELECT metric, value FROM (UNPIVOT one ON COLUMNS(*) INTO NAME metric VALUE value)""")
wide("timestamp_lag", "SELECT row_id, (ship_date - order_date)::INT AS time_difference FROM wide")
wide("order_lookup_join", "SELECT row_id, order_key, customer_key, order_date_key FROM wide")
_RULE = """g AS (SELECT ship_mode_name AS y, CASE WHEN discount > 0.07::DOUBLE THEN 'Standard Class'
  WHEN quantity > 35 THEN 'First Class' WHEN sales > 30000 THEN 'Same Day' ELSE 'Standard Class' END AS p FROM wide)"""
_cells = ", ".join(f"count(*) FILTER (p = '{m}') AS \"predicted_{m}\"" for m in SHIP_MODES)
wide("confusion_matrix", f"SELECT y AS label, {_cells} FROM g GROUP BY 1", _RULE)
_REPORT = f"""{_RULE}, s AS (SELECT label, (SELECT count(*) FROM g WHERE y = label AND p = label)::DOUBLE AS tp,
  (SELECT count(*) FROM g WHERE y = label)::DOUBLE AS support, (SELECT count(*) FROM g WHERE p = label)::DOUBLE AS predicted
  FROM (SELECT unnest({SHIP_MODES}) AS label)),
r AS (SELECT label, coalesce(tp / nullif(predicted, 0), 0) AS precision, coalesce(tp / nullif(support, 0), 0) AS recall,
  2 * tp / (predicted + support) AS f1, support, tp FROM s)"""
wide("classification_report", """SELECT label, round(precision, 9) AS precision, round(recall, 9) AS recall,
  round(f1, 9) AS f1, support FROM (SELECT label, precision, recall, f1, support FROM r
  UNION ALL SELECT 'accuracy', sum(tp) / sum(support), sum(tp) / sum(support), sum(tp) / sum(support), sum(support) FROM r
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM r
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
    sum(f1 * support) / sum(support), sum(support) FROM r)""", _REPORT)
wide("accuracy_and_macro_f1", "SELECT round(sum(tp) / sum(support), 9) AS accuracy, round(avg(f1), 9) AS f1_macro FROM r", _REPORT)
_ERRORS = f""", e AS (SELECT profit AS y, profit - (sales * 0.1::DOUBLE - quantity * 5) AS e, {HASH} % 100 < 80 AS t FROM line)"""
line("regression_metrics", f"""{_ERRORS} SELECT count(*) AS n, round(1 - avg(e * e) / var_pop(y), 4) AS r2, round(avg(e * e), 4) AS mse,
  round(sqrt(avg(e * e)), 4) AS rmse, round(avg(abs(e)), 4) AS mae FROM e""")
line("regression_table", f"""{_ERRORS}, a AS (SELECT 1 - avg(e * e) FILTER (t) / var_pop(y) FILTER (t) AS r2_train,
  1 - avg(e * e) FILTER (NOT t) / var_pop(y) FILTER (NOT t) AS r2_test, avg(e * e) FILTER (NOT t) AS mse_test,
  avg(abs(e)) FILTER (NOT t) AS mae_test FROM e)
SELECT unnest(['r2_train', 'r2_test', 'r2_gap_points', 'mse_test', 'rmse_test', 'mae_test']) AS metric,
  unnest([round(r2_train, 4), round(r2_test, 4), round((r2_train - r2_test) * 100, 2), round(mse_test, 4),
          round(sqrt(mse_test), 4), round(mae_test, 4)]) AS value FROM a""")

# Customers in clusters
_CUSTOMERS = f"""c AS (SELECT customer_id, {', '.join(f'sum({m}) AS {m}' for m in MEASURES)},
  count(*) FILTER (order_year = 1995)::DOUBLE AS year_1995 FROM kept GROUP BY 1),
k AS (SELECT *, CASE WHEN quantity > 800 THEN 2 WHEN quantity > 500 THEN 1 ELSE 0 END AS cluster FROM c)"""
_stats = ", ".join(f"round(avg({m}), 4) AS {m}_mean, round(min({m}), 4) AS {m}_min, round(max({m}), 4) AS {m}_max" for m in MEASURES)
wide("profile_by_rule", f"SELECT cluster, count(*) AS customers, {_stats} FROM k GROUP BY 1", _CUSTOMERS)
_SILHOUETTE = f"""{_CUSTOMERS}, d AS (SELECT a.customer_id, a.cluster, b.cluster AS other,
  sum(pow(a.quantity - b.quantity, 2) + pow(a.discount - b.discount, 2) + pow(a.year_1995 - b.year_1995, 2)) AS s, count(*) AS n
  FROM k a, k b GROUP BY 1, 2, 3),
s AS (SELECT customer_id, cluster, max(s / nullif(n - 1, 0)) FILTER (other = cluster) AS a, max(n) FILTER (other = cluster) AS n,
  min(s / n) FILTER (other <> cluster) AS b FROM d GROUP BY 1, 2),
v AS (SELECT customer_id, cluster, CASE WHEN n = 1 THEN 0 ELSE coalesce((b - a) / nullif(greatest(a, b), 0), 0) END AS silhouette FROM s)"""
wide("silhouette_rows", "SELECT customer_id, cluster, round(silhouette, 8) AS silhouette FROM v", _SILHOUETTE)
wide("cluster_quality", """SELECT round((SELECT sum(i) FROM (SELECT (var_pop(quantity) + var_pop(discount) + var_pop(year_1995)) * count(*) AS i
  FROM k GROUP BY cluster)), 4) AS inertia, round(avg(silhouette), 4) AS silhouette FROM v""", _SILHOUETTE)

# Returned orders
_TRAIN = f"""t AS (SELECT is_returned, count(*) AS n FROM wide
  WHERE {HASH} % 100 < 80 GROUP BY 1)"""
wide("smote_counts", """SELECT is_returned, false AS is_synthetic, n AS rows FROM t
  UNION ALL SELECT is_returned, true, (SELECT max(n) FROM t) - n FROM t WHERE n < (SELECT max(n) FROM t)""", _TRAIN)
wide("smote_nc_counts", """SELECT ship_mode_name, false AS is_synthetic, n AS rows FROM t
  UNION ALL SELECT ship_mode_name, true, (SELECT max(n) FROM t) - n FROM t WHERE n < (SELECT max(n) FROM t)""",
  "t AS (SELECT ship_mode_name, floor(count(*) * 0.75)::BIGINT AS n FROM wide GROUP BY 1)")
wide("returned_prediction_ids", f"SELECT row_id, is_returned AS true_label FROM wide WHERE {HASH} % 100 >= 80")
