"""Contract rules (V1-V3), session audit on hand-made sessions (V4), V5."""

import datetime as dt

from pyspark.sql import functions as F

from tidewater.operators import quality
from tidewater.operators.wire import bronze_from_wire

COLS = ("event_id user_id session_id content_id content_type event_type watch_seconds "
        "playback_position_seconds device_type app_version country_code event_timestamp").split()
SCHEMA = ("event_id string, user_id string, session_id string, content_id string, content_type string, "
          "event_type string, watch_seconds int, playback_position_seconds int, device_type string, "
          "app_version string, country_code string, event_timestamp timestamp")
T0 = dt.datetime(2024, 1, 1, 12)
GOOD = ("x" * 36, "u-1", "s-1", "c-1", "movie", "play", 10, 5, "web", "1.0.0", "IN", T0)


def _row(**kw):
    r = dict(zip(COLS, GOOD))
    r.update(kw)
    return tuple(r[c] for c in COLS)


def _violations(spark, **kw):
    df = spark.createDataFrame([_row(**kw)], SCHEMA)
    return quality.validate_events(df).collect()[0]["violations"]


def test_clean_row_has_no_violation(spark):
    assert _violations(spark) == []


def test_each_rule(spark):
    assert _violations(spark, event_id="short") == ["event_id_length"]
    assert _violations(spark, user_id="") == ["user_id_length"]
    assert _violations(spark, session_id="s" * 65) == ["session_id_length"]
    assert _violations(spark, content_type="x" * 33) == ["content_type_length"]
    assert _violations(spark, country_code="IND") == ["country_code_length"]
    assert _violations(spark, event_type="rewind") == ["event_type_unknown"]
    assert _violations(spark, device_type="fridge") == ["device_type_unknown"]
    assert _violations(spark, watch_seconds=86401) == ["watch_seconds_range"]
    assert _violations(spark, playback_position_seconds=-1) == ["position_range"]


def test_null_raises_only_missing(spark):
    assert _violations(spark, event_id=None) == ["event_id_missing"]
    assert _violations(spark, country_code=None) == ["country_code_missing"]
    assert _violations(spark, watch_seconds=None) == []  # has a default
    assert _violations(spark, playback_position_seconds=None) == []  # optional
    assert _violations(spark, event_timestamp=None) == ["event_timestamp_missing"]


def test_violations_sorted_and_several(spark):
    assert _violations(spark, event_id="a", device_type="x", country_code=None) == [
        "country_code_missing", "device_type_unknown", "event_id_length"]


def test_quarantine_split_partitions_rows(spark):
    df = spark.createDataFrame([_row(), _row(event_id="bad"), _row(user_id=None)], SCHEMA)
    valid, rejected = quality.quarantine_split(df)
    assert valid.count() == 1 and rejected.count() == 2
    assert valid.columns == df.columns and "violations" in rejected.columns
    rules = quality.contract_rules(exclude=("event_id_length",))
    v2, r2 = quality.quarantine_split(df, rules)
    assert v2.count() == 2 and r2.count() == 1


def test_violation_counts(spark):
    df = spark.createDataFrame([_row(event_id="a"), _row(event_id="b", device_type="x")], SCHEMA)
    got = {r["violation"]: r["rows"] for r in quality.violation_counts(df).collect()}
    assert got == {"event_id_length": 2, "device_type_unknown": 1}


def test_violation_counts_parses_each_message_once(spark):
    rows = [('{"event_id": "%s", "device_type": "x"}' % i, 0, i) for i in "abc"] + [("not json", 1, "d")]
    wire = spark.createDataFrame(rows, "value string, partition int, key string").selectExpr("key", "value", "partition", "1L as offset", "timestamp'2024-01-01' as timestamp")
    counted = quality.violation_counts(bronze_from_wire(wire))
    assert counted._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
    got = {r["violation"]: r["rows"] for r in counted.collect()}
    assert got["device_type_unknown"] == 3 and got["event_id_length"] == 3 and got["event_id_missing"] == 1
    assert got["user_id_missing"] == 4 and min(got.values()) > 0


def _session(spark, events, session="s-1"):
    """events: list of (seconds offset, event_type, watch_seconds[, app_version])."""
    rows = []
    for i, e in enumerate(events):
        off, etype, watch = e[:3]
        ver = e[3] if len(e) > 3 else "1.0.0"
        r = _row(event_id=f"e{i:035d}", session_id=session, event_type=etype, watch_seconds=watch,
                 app_version=ver, event_timestamp=T0 + dt.timedelta(seconds=off))
        rows.append(r + (i,))
    return spark.createDataFrame(rows, SCHEMA + ", kafka_offset long")


def _audit(spark, events, **kw):
    return quality.session_audit(_session(spark, events), **kw).collect()[0].asDict()


def test_clean_session(spark):
    a = _audit(spark, [(0, "play", 0), (5, "pause", 5), (9, "resume", 5), (20, "play", 15), (30, "complete", 25)])
    assert a == {"session_id": "s-1", "events": 5, "starts_with_play": True, "resume_without_pause": 0,
                 "events_after_terminal": 0, "watch_decreases": 0, "attribute_changes": 0}


def test_first_event_not_play(spark):
    assert _audit(spark, [(0, "seek", 0), (5, "play", 5)])["starts_with_play"] is False


def test_resume_without_open_pause(spark):
    a = _audit(spark, [(0, "play", 0), (1, "resume", 0), (2, "pause", 0), (3, "resume", 0), (4, "resume", 0)])
    assert a["resume_without_pause"] == 2


def test_events_after_terminal(spark):
    a = _audit(spark, [(0, "play", 0), (1, "error", 0), (2, "play", 1), (3, "complete", 2)])
    assert a["events_after_terminal"] == 2


def test_watch_decreases(spark):
    assert _audit(spark, [(0, "play", 10), (1, "play", 5), (2, "play", 7), (3, "play", 6)])["watch_decreases"] == 2


def test_attribute_changes(spark):
    a = _audit(spark, [(0, "play", 0, "1.0.0"), (1, "play", 1, "1.1.0"), (2, "play", 2, "1.2.0")])
    assert a["attribute_changes"] == 2


def test_order_ties_broken_by_offset_and_buckets(spark):
    # Same timestamp: offset decides. Spread over many small buckets: same answer.
    ev = [(0, "play", 0), (0, "play", 3), (0, "play", 2), (25, "play", 1), (40, "pause", 1), (70, "resume", 1)]
    a = _audit(spark, ev)
    b = _audit(spark, ev, hot_rows=1, slice_rows=1)
    assert a == b and a["watch_decreases"] == 2 and a["resume_without_pause"] == 0


def test_ingest_metrics(spark):
    df = spark.createDataFrame(
        [(b"k", b'{"event_id":"a"}', 0, 5), (b"k", b"not json", 0, 6), (b"k", None, 1, 1)],
        "key binary, value binary, partition int, offset long")
    got = {r["kafka_partition"]: r.asDict() for r in quality.ingest_metrics(df).collect()}
    assert got[0]["messages"] == 2 and got[0]["parsed"] == 1 and got[0]["failed"] == 1
    assert got[0]["bytes"] == len(b'{"event_id":"a"}') + len(b"not json")
    assert got[0]["min_offset"] == 5 and got[0]["max_offset"] == 6
    assert got[1]["failed"] == 1


def test_silver_report(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "event_id string")
    r = quality.silver_report(df).collect()[0].asDict()
    assert r == {"bronze_rows": 4, "unparsed_rows": 1, "duplicate_rows": 1, "silver_rows": 2, "dropped_rows": 2}


def test_write_quarantine_one_job_partitioned_by_status(spark, lake):
    from tidewater.sinks.storage import read_path
    from tidewater.sinks.tables import write_quarantine

    ok = _row()
    bad = _row(event_id=None, event_type="dance")
    df = spark.createDataFrame([ok, bad], SCHEMA)
    write_quarantine(df, lake)
    back = read_path(spark, lake, lake.path("quarantine", "user_events"))
    rejected = back.filter(F.col("status") == "rejected")
    assert "PartitionFilters" in rejected._jdf.queryExecution().executedPlan().toString()
    assert rejected.count() == 1 and back.filter(F.col("status") == "valid").count() == 1
    assert sorted(rejected.collect()[0]["violations"]) == ["event_id_missing", "event_type_unknown"]
