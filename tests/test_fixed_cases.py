"""Cases that once gave wrong results, on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from tidewater.functions.expr import contains_ci
from tidewater.operators.gold import daily_watch_time_accurate
from tidewater.operators.quality import session_audit
from tidewater.operators.wire import to_wire
from tidewater.schema import EVENT_COLUMNS


def test_audit_counts_null_types_after_a_terminal_event(spark):
    rows = [(i, f"2024-01-01 00:00:0{i}", t) for i, t in enumerate(["play", "complete", None, "play"])]
    df = spark.createDataFrame(rows, "event_id int, ts string, event_type string").select(
        "event_id", F.lit("s").alias("session_id"), F.col("ts").cast("timestamp").alias("event_timestamp"), "event_type",
        F.lit(1).alias("watch_seconds"), *[F.lit("x").alias(c) for c in ("user_id", "content_id", "content_type", "device_type", "app_version", "country_code")],
    )
    for hot in (1_000_000, 0):
        assert session_audit(df, tie="event_id", hot_rows=hot).first().events_after_terminal == 2


def test_accurate_watch_time_looks_past_a_day_without_value(spark):
    rows = [("s", "IN", "2024-01-01", 100), ("s", "IN", "2024-01-02", None), ("s", "IN", "2024-01-03", 150)]
    df = spark.createDataFrame(rows, "session_id string, country_code string, event_date string, watch_seconds int")
    got = {r.event_date: r.total_watch_seconds for r in daily_watch_time_accurate(df).collect()}
    assert got == {"2024-01-01": 100, "2024-01-02": None, "2024-01-03": 50}


def test_search_folds_case_beyond_ascii(spark):
    df = spark.createDataFrame([("ÉMILE",), ("emile",), (None,)], "u string")
    assert [r[0] for r in df.select(contains_ci("u", "émile", literal=True)).collect()] == [True, False, False]


def test_to_wire_never_writes_a_null_key(spark):
    df = spark.range(1).select(*[F.lit(None).cast("string").alias(c) for c in EVENT_COLUMNS])
    with pytest.raises(Exception, match="user_id is NULL"):
        to_wire(df).collect()
