"""P4 stamps, P8 display names, O1/O2 Gold ordering."""

import datetime as dt

from pyspark.sql import functions as F

from tidewater.operators import enrich, gold


def test_p4_stamps_use_the_injected_clock_or_now(spark):
    df = spark.createDataFrame([(1,)], "x int")
    clock = dt.datetime(2024, 2, 1)
    assert enrich.stamp_ingested(df, clock).collect()[0]["ingested_at"] == clock
    row = enrich.stamp_transformed(df).select(
        (F.abs(F.unix_timestamp("transformed_at") - F.unix_timestamp(F.current_timestamp())) < 60).alias("ok")
    ).collect()[0]
    assert row["ok"]


def test_p8_rename_display_keeps_values(spark):
    df = spark.createDataFrame([("s-1", 3)], "session_id string, event_count long")
    out = enrich.rename_display(df, {"session_id": "Session", "event_count": "Events"})
    assert out.columns == ["Session", "Events"] and tuple(out.collect()[0]) == ("s-1", 3)


def test_o1_o2_gold_order_with_tie_breaks(spark):
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    g1 = spark.createDataFrame(
        [(d2, "IN", 5, 1, 1, 1), (d1, "US", 7, 1, 1, 1), (d1, "IN", 7, 1, 1, 1), (None, "GB", 1, 1, 1, 1),
         (d1, "AE", 9, 1, 1, 1)],
        "event_date date, country_code string, total_watch_seconds long, unique_users long, "
        "unique_sessions long, event_count long",
    )
    got = [(r["event_date"], r["country_code"]) for r in gold.ordered(g1, "daily_watch_time_by_country").collect()]
    assert got == [(None, "GB"), (d1, "AE"), (d1, "IN"), (d1, "US"), (d2, "IN")]
    g2 = spark.createDataFrame([("c2", "movie", 5), ("c1", "movie", 5), ("c3", "live", 9)],
                               "content_id string, content_type string, total_watch_seconds long")
    got = [r["content_id"] for r in gold.ordered(g2, "top_content_by_watch_time").collect()]
    assert got == ["c3", "c1", "c2"]
