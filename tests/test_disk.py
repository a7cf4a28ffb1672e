"""What large frames write: lines meet their orders once, in few columns, and are staged compressed."""

import dataclasses

from tallyloom.plans import frames, jobs
from tallyloom.session import stage_compact
from tallyloom.sources.star import DIMENSIONS, denormalise


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_the_threshold_frame_reads_rows_that_were_joined_once(star):
    assert "Join" not in plan(frames.regression_frame_thresholds(star))


def test_joins_carry_the_lines_in_few_columns(star):
    """The ids and amounts that follow from other columns are worked out above all joins, and are the same."""
    wide = denormalise(star, DIMENSIONS, order_dates=True, ship_dates=True)
    told = plan(wide.select("row_id", "profit", "category", "city"))
    assert "Join" in told and told.index("concat_ws") < told.index("Join")
    columns = ["row_id", "profit", "shipping_cost", "sales", "ship_mode_name", "category", "city", "order_date", "ship_date", "is_returned"]
    other = denormalise(dataclasses.replace(star, narrow=None), DIMENSIONS, order_dates=True, ship_dates=True)
    assert set(wide.columns) == set(other.columns)
    rows, others = (sorted(map(tuple, w.select(columns).collect()), key=str) for w in (wide, other))
    assert rows == others and len(rows) == star.lines.count()


def test_orders_are_staged_in_columns(star):
    train, _ = jobs.split_orders(star)
    assert "parquet" in plan(train)


def test_compact_rows_are_the_same_rows(spark, star):
    df = star.customer.limit(50).cache()
    assert sorted(stage_compact(df).collect()) == sorted(df.collect())
    assert stage_compact(df.limit(0)).count() == 0
    train, _ = jobs.prepared_orders(star)
    assert train.schema["features"].metadata["ml_attr"]["num_attrs"] == len(train.first()["x"])
