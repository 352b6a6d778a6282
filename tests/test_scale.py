"""Hot keys, plan shape and invariants that must hold at any scale.

A hot key here holds a third or more of all rows. The checks are: results equal
the plain (one-task-per-key) formulation, and the physical plan aggregates
map-side before the shuffle, so a hot key costs one row per map task there.
"""

import datetime as dt
import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater.operators import gold, quality
from tidewater.sources.wire import kafka_options

T0 = dt.datetime(2024, 1, 1)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedupe_hot_event_id_aggregates_before_the_shuffle(spark):
    # One event_id holds half of the rows (a retry storm).
    rows = [("hot", p % 3, 1000 - p, f"v{p}") for p in range(600)]
    rows += [(f"e{i}", 0, i, f"w{i}") for i in range(600)]
    df = spark.createDataFrame(rows, "event_id string, kafka_partition int, kafka_offset long, payload string")
    out = quality.dedupe_events(df)
    got = {r["event_id"]: (r["kafka_partition"], r["kafka_offset"], r["payload"]) for r in out.collect()}
    assert len(got) == 601
    # Survivor: lowest (partition, offset): partition 0, smallest offset among p % 3 == 0.
    best = min((p % 3, 1000 - p, f"v{p}") for p in range(600))
    assert got["hot"] == best
    # Partial aggregate under the exchange: two aggregate operators around it.
    text = out._jdf.queryExecution().sparkPlan().toString()
    assert text.count("Aggregate") >= 2


def test_session_audit_hot_session_equals_plain_windows(spark):
    rnd = random.Random(3)
    types = ["play", "pause", "resume", "seek", "complete", "error"]
    rows = []
    for i in range(3000):
        s = "s-hot" if rnd.random() < 0.4 else f"s-{rnd.randint(0, 40)}"
        ts = T0 + dt.timedelta(seconds=rnd.randint(0, 900))
        rows.append((s, ts, i, rnd.choice(types), rnd.randint(0, 500), "u", "c", "movie", "web",
                     rnd.choice(["1.0.0", "1.1.0"]), "IN"))
    df = spark.createDataFrame(
        rows,
        "session_id string, event_timestamp timestamp, kafka_offset long, event_type string, "
        "watch_seconds int, user_id string, content_id string, content_type string, device_type string, "
        "app_version string, country_code string",
    )
    got = {r["session_id"]: r.asDict() for r in quality.session_audit(df, hot_rows=100, slice_rows=100).collect()}

    w = Window.partitionBy("session_id").orderBy("event_timestamp", "kafka_offset")
    term = F.col("event_type").isin("complete", "error").cast("int")
    plain = df.select(
        "*",
        F.lag("watch_seconds").over(w).alias("pw"),
        (F.sum(term).over(w.rowsBetween(Window.unboundedPreceding, 0)) - term).alias("tb"),
        F.last(F.when(F.col("event_type").isin("pause", "resume"), F.col("event_type")), ignorenulls=True)
        .over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("lpr"),
        F.row_number().over(w).alias("rn"),
    )
    ref = plain.groupBy("session_id").agg(
        F.count(F.lit(1)).alias("events"),
        F.max(F.when(F.col("rn") == 1, F.col("event_type") == "play")).alias("starts_with_play"),
        F.count_if((F.col("event_type") == "resume") & F.coalesce(F.col("lpr") != "pause", F.lit(True)))
        .alias("resume_without_pause"),
        F.count_if(F.col("tb") > 0).alias("events_after_terminal"),
        F.count_if(F.coalesce(F.col("pw") > F.col("watch_seconds"), F.lit(False))).alias("watch_decreases"),
        (F.count_distinct("app_version") - 1).alias("attribute_changes"),
    )
    want = {r["session_id"]: r.asDict() for r in ref.collect()}
    assert got.keys() == want.keys()
    for k in want:
        for c in want[k]:
            assert got[k][c] == want[k][c], (k, c)
    assert got["s-hot"]["events"] > 1000


def test_ordered_scan_is_a_plain_window_without_hot_keys(spark):
    from tidewater.functions.windows import ordered_scan

    df = spark.createDataFrame([("a", T0, 1, 1), ("a", T0, 2, 2)], "k string, ts timestamp, tie long, v int")
    plan = _plan(ordered_scan(df, ["k"], "ts", "tie", running_sum=["v"]))
    # No key is hot: one window per key, no slices, no carry join.
    assert "Window" in plan and "Join" not in plan and "_tw_slice" not in plan


def test_daily_watch_time_accurate_counts_midnight_sessions_once(spark):
    rows = [
        ("s1", "IN", dt.date(2024, 1, 1), 100),
        ("s1", "IN", dt.date(2024, 1, 1), 300),
        ("s1", "IN", dt.date(2024, 1, 2), 450),  # same session after midnight: +150
        ("s2", "IN", dt.date(2024, 1, 2), 50),
        ("s3", "US", dt.date(2024, 1, 1), None),
    ]
    df = spark.createDataFrame(rows, "session_id string, country_code string, event_date date, watch_seconds int")
    got = {(r["event_date"], r["country_code"]): r["total_watch_seconds"]
           for r in gold.daily_watch_time_accurate(df).collect()}
    assert got == {(dt.date(2024, 1, 1), "IN"): 300, (dt.date(2024, 1, 2), "IN"): 200,
                   (dt.date(2024, 1, 1), "US"): None}


ids = st.text(alphabet="abc", min_size=1, max_size=2)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(ids, st.integers(0, 3), st.integers(0, 50)), min_size=1, max_size=40))
def test_dedupe_is_idempotent_and_keeps_one_row_per_id(spark, rows):
    df = spark.createDataFrame(rows, "event_id string, kafka_partition int, kafka_offset long")
    once = quality.dedupe_events(df)
    twice = quality.dedupe_events(once)
    a = sorted(tuple(r) for r in once.collect())
    assert a == sorted(tuple(r) for r in twice.collect())
    assert len(a) == len({r[0] for r in rows})
    for eid, p, o in a:
        assert (p, o) == min((rp, ro) for re, rp, ro in rows if re == eid)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["IN", "US"]), st.sampled_from(["u1", "u2", "u3"]),
                          st.sampled_from(["s1", "s2"]), st.integers(0, 9)), min_size=1, max_size=30))
def test_gold_invariants(spark, rows):
    df = spark.createDataFrame(
        [(dt.date(2024, 1, 1 + (w % 2)), c, u, s, w) for c, u, s, w in rows],
        "event_date date, country_code string, user_id string, session_id string, watch_seconds int",
    )
    g1 = gold.daily_watch_time_by_country(df).collect()
    assert sum(r["event_count"] for r in g1) == len(rows)
    assert sum(r["total_watch_seconds"] for r in g1) == sum(r[3] for r in rows)
    for r in g1:
        assert 1 <= r["unique_users"] <= r["event_count"]
        assert 1 <= r["unique_sessions"] <= r["event_count"]


def test_kafka_options_contract():
    o = kafka_options("b:9092", "user_events", api_key="k", api_secret="s", max_offsets_per_trigger=500,
                      min_partitions=600)
    assert o["minPartitions"] == "600"
    assert o["subscribe"] == "user_events" and o["startingOffsets"] == "earliest"
    assert o["failOnDataLoss"] == "false" and o["kafka.security.protocol"] == "SASL_SSL"
    assert o["kafka.sasl.mechanism"] == "PLAIN" and 'username="k"' in o["kafka.sasl.jaas.config"]
    assert o["maxOffsetsPerTrigger"] == "500"
    plain = kafka_options("b:9092", "t")
    assert "kafka.security.protocol" not in plain and "maxOffsetsPerTrigger" not in plain


def test_compaction_splits_a_hot_clustering_value(spark, lake):
    from tidewater.sinks.compact import compact_table
    from tidewater.sinks.storage import read_path, write_table

    rows = [("hot" if i % 2 else f"u{i}", T0 + dt.timedelta(seconds=i), f"e{i}") for i in range(400)]
    df = spark.createDataFrame(rows, "user_id string, event_timestamp timestamp, event_id string")
    path = lake.path("silver", "hot")
    write_table(df, lake, path)
    compact_table(spark, lake, path, cluster_by=("user_id",), target_files=4)
    back = read_path(spark, lake, path)
    assert sorted(map(tuple, back.collect())) == sorted(rows)
    per_file = back.groupBy(F.input_file_name().alias("f")).agg(F.count_if(F.col("user_id") == "hot").alias("n"))
    counts = [r["n"] for r in per_file.collect()]
    assert len(counts) >= 2 and max(counts) < 200


def test_shuffle_width_sizes_and_restores(spark):
    from tidewater.session import shuffle_width

    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with shuffle_width(spark, 10 * 1024 ** 4) as w:  # 10 TB of input
        assert w == 40_960 and spark.conf.get(key) == "40960"
    assert spark.conf.get(key) == before
    with shuffle_width(spark, 1000) as w:  # tiny input keeps the session's width
        assert w == int(before)
    with shuffle_width(spark, 10 ** 15) as w:  # a petabyte: no upper bound of ours
        assert w == -(-10 ** 15 // (256 * 1024 ** 2))


def test_kafka_source_builds_the_reader_it_documents():
    from tidewater.sources.wire import kafka_source

    calls = {}

    class Reader:
        def format(self, f):
            calls["format"] = f
            return self

        def options(self, **o):
            calls["options"] = o
            return self

        def load(self):
            calls["loaded"] = True
            return "stream"

    class Session:
        readStream = Reader()
        read = Reader()

    assert kafka_source(Session(), "b:9092", "user_events", max_offsets_per_trigger=10) == "stream"
    assert calls["format"] == "kafka" and calls["options"]["subscribe"] == "user_events"
    assert calls["options"]["maxOffsetsPerTrigger"] == "10"
    kafka_source(Session(), "b:9092", "user_events", streaming=False, max_offsets_per_trigger=10)
    assert "maxOffsetsPerTrigger" not in calls["options"]  # batch reads take no rate limit


def test_run_jobs_keeps_order_and_raises_failures():
    import pytest

    from tidewater.plans.parallel import run_jobs

    assert list(run_jobs({"b": lambda: 2, "a": lambda: 1}).items()) == [("b", 2), ("a", 1)]

    def boom():
        raise RuntimeError("publish failed")

    with pytest.raises(RuntimeError, match="publish failed"):
        run_jobs({"ok": lambda: 1, "bad": boom})
    assert run_jobs({"x": lambda: 3}, concurrent=False) == {"x": 3}
