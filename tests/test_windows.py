"""The skew-safe ordered scan (plain and sliced paths) equals the plain one-task-per-key windows."""

import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater.functions.windows import cumulative_sum, previous_row


def _data(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        key = "hot" if rnd.random() < 0.4 else f"k{rnd.randint(0, 30)}"  # one key holds ~40 %
        ts = t0 + dt.timedelta(seconds=rnd.randint(0, 3600), microseconds=rnd.choice([0, 1]))
        rows.append((key, ts, i, rnd.randint(-5, 50)))
    return spark.createDataFrame(rows, "k string, ts timestamp, tie long, v int")


@pytest.mark.parametrize("hot_rows", [0, 100, 1_000_000])
def test_cumulative_sum_matches_window(spark, hot_rows):
    df = _data(spark)
    got = cumulative_sum(df, ["k"], "ts", "tie", "v", "cum", hot_rows=hot_rows, slice_rows=70)
    w = Window.partitionBy("k").orderBy("ts", "tie").rowsBetween(Window.unboundedPreceding, 0)
    ref = df.withColumn("cum", F.sum("v").over(w))
    assert got.select("tie", "cum").exceptAll(ref.select("tie", "cum")).count() == 0
    assert got.count() == df.count()


@pytest.mark.parametrize("hot_rows", [0, 100, 1_000_000])
def test_previous_row_matches_lag(spark, hot_rows):
    df = _data(spark)
    got = previous_row(df, ["k"], "ts", "tie", ["v", "tie"], out="p", hot_rows=hot_rows, slice_rows=130)
    w = Window.partitionBy("k").orderBy("ts", "tie")
    ref = df.withColumn("p", F.lag(F.struct("v", "tie")).over(w))
    a = got.select("tie", F.col("p.v").alias("pv"), F.col("p.tie").alias("pt"))
    b = ref.select("tie", F.col("p.v").alias("pv"), F.col("p.tie").alias("pt"))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("hot_rows", [0, 100, 1_000_000])
def test_previous_row_null_timestamps_sort_first(spark, hot_rows):
    df = spark.createDataFrame(
        [("a", None, 1, 1), ("a", dt.datetime(2024, 1, 1), 2, 2), ("a", None, 0, 0)],
        "k string, ts timestamp, tie long, v int")
    got = {r["tie"]: (r["p"]["v"] if r["p"] else None)
           for r in previous_row(df, ["k"], "ts", "tie", ["v"], out="p", hot_rows={100: 1}.get(hot_rows, hot_rows), slice_rows=1).collect()}
    assert got == {0: None, 1: 0, 2: 1}


@pytest.mark.parametrize("hot_rows", [0, 100, 1_000_000])
def test_cumulative_sum_keeps_null_keys_and_null_values(spark, hot_rows):
    rows = [("a", dt.datetime(2024, 1, 1, 0, 0, 0), 1, None), ("a", dt.datetime(2024, 1, 1, 0, 0, 1), 2, 5),
            ("a", dt.datetime(2024, 1, 1, 0, 1, 0), 3, None), ("a", None, 0, 7), (None, dt.datetime(2024, 1, 1), 4, 2),
            ("b", dt.datetime(2024, 1, 1), 5, None)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, tie long, v int")
    got = {r["tie"]: r["cum"] for r in cumulative_sum(df, ["k"], "ts", "tie", "v", "cum", hot_rows={100: 1}.get(hot_rows, hot_rows), slice_rows=1).collect()}
    w = Window.partitionBy("k").orderBy("ts", "tie").rowsBetween(Window.unboundedPreceding, 0)
    ref = {r["tie"]: r["cum"] for r in df.withColumn("cum", F.sum("v").over(w)).collect()}
    assert got == ref and len(got) == 6


@pytest.mark.parametrize("hot_rows", [0, 100, 1_000_000])
def test_ordered_scan_last_non_null_before_and_has_prev(spark, hot_rows):
    from tidewater.functions.windows import ordered_scan

    rnd = random.Random(11)
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(2000):
        key = "hot" if rnd.random() < 0.5 else f"k{rnd.randint(0, 20)}"
        ts = None if rnd.random() < 0.02 else t0 + dt.timedelta(seconds=rnd.randint(0, 600))
        v = None if rnd.random() < 0.7 else rnd.choice(["pause", "resume"])
        rows.append((key, ts, i, v))
    df = spark.createDataFrame(rows, "k string, ts timestamp, tie long, v string")
    got = ordered_scan(df, ["k"], "ts", "tie", last_before=["v"], lag=["tie"], prefix="s_",
                       hot_rows=hot_rows, slice_rows=90)
    w = Window.partitionBy("k").orderBy(F.col("ts").asc_nulls_first(), F.col("tie").asc_nulls_first())
    ref = df.select(
        "tie",
        F.last("v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("s_last_v"),
        F.lag("tie").over(w).alias("s_prev_tie"),
        F.lag("tie").over(w).isNotNull().alias("s_has_prev"),
    )
    a = got.select("tie", "s_last_v", "s_prev_tie", "s_has_prev")
    assert a.count() == 2000
    assert a.exceptAll(ref).count() == 0 and ref.exceptAll(a).count() == 0



def test_hot_keys_are_few_and_bounded(spark):
    from tidewater.functions.windows import hot_keys

    rows = [("hot",)] * 500 + [(f"k{i}",) for i in range(500)]
    df = spark.createDataFrame(rows, "k string")
    got = [r["k"] for r in hot_keys(df, "k", hot_rows=10, max_hot_keys=100).collect()]
    assert got == ["hot"]
    # The share rule alone: more than total / max_hot_keys rows; never max_hot_keys keys or more.
    many = spark.createDataFrame([(f"k{i % 50}",) for i in range(1000)], "k string")
    assert hot_keys(many, "k", hot_rows=1, max_hot_keys=50).count() == 0
    assert hot_keys(many, "k", hot_rows=1, max_hot_keys=51).count() == 50


def test_only_hot_keys_get_sliced(spark):
    from tidewater.functions.windows import ordered_scan

    df = _data(spark, n=400)
    plan = ordered_scan(df, ["k"], "ts", "tie", running_sum=["v"], hot_rows=50)._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert "BroadcastHashJoin" in text or "BroadcastExchange" in text


@pytest.mark.parametrize("spread_us", [0, 2_000_000])
def test_dense_hot_key_is_sliced_with_same_results(spark, spread_us):
    """A hot key with all rows in two seconds, or all on one timestamp (ties
    decide the order): slicing by range still matches the plain window."""
    from tidewater.functions.windows import ordered_scan

    rnd = random.Random(5)
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(2000):
        if rnd.random() < 0.5:
            rows.append(("hot", t0 + dt.timedelta(microseconds=rnd.randint(0, spread_us)), i, rnd.randint(0, 9)))
        else:
            rows.append((f"k{rnd.randint(0, 50)}", t0 + dt.timedelta(seconds=rnd.randint(0, 3600)), i, rnd.randint(0, 9)))
    df = spark.createDataFrame(rows, "k string, ts timestamp, tie long, v int")
    got = ordered_scan(df, ["k"], "ts", "tie", running_sum=["v"], lag=["v"], prefix="s_",
                       hot_rows=200, slice_rows=50)
    w = Window.partitionBy("k").orderBy("ts", "tie")
    ref = df.select(
        "tie",
        F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("s_cum_v"),
        F.lag("v").over(w).alias("s_prev_v"),
        (F.row_number().over(w) > 1).alias("s_has_prev"),
    )
    a = got.select("tie", "s_cum_v", "s_prev_v", "s_has_prev")
    assert a.count() == 2000 and a.exceptAll(ref).count() == 0 and ref.exceptAll(a).count() == 0


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    rows=st.lists(
        st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(0, 5)),
                  st.one_of(st.none(), st.integers(-3, 3))),
        min_size=1, max_size=40),
    hot_rows=st.sampled_from([0, 1, 3, 1_000_000]),
    slice_rows=st.integers(1, 7),
)
def test_ordered_scan_equals_plain_windows(spark, rows, hot_rows, slice_rows):
    from tidewater.functions.windows import ordered_scan

    t0 = dt.datetime(2024, 1, 1)
    data = [(k, None if s is None else t0 + dt.timedelta(seconds=s), i, v) for i, (k, s, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "k string, ts timestamp, tie long, v int")
    got = ordered_scan(df, ["k"], "ts", "tie", lag=["v"], running_sum=["v"], last_before=["v"], prefix="s_",
                       hot_rows=hot_rows, slice_rows=slice_rows)
    w = Window.partitionBy("k").orderBy(F.col("ts").asc_nulls_first(), F.col("tie").asc_nulls_first())
    ref = df.select(
        "tie",
        (F.row_number().over(w) > 1).alias("s_has_prev"),
        F.lag("v").over(w).alias("s_prev_v"),
        F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("s_cum_v"),
        F.last("v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("s_last_v"),
    )
    a = sorted(tuple(r) for r in got.select(*ref.columns).collect())
    b = sorted(tuple(r) for r in ref.collect())
    assert a == b
