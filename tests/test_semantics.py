"""One test per pinned semantics row (S1-S16) that has behaviour of its own."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators import gold, quality, serving, wire
from tidewater.operators.enrich import enrich_silver
from tidewater.schema import EVENT_COLUMNS

SMALL = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("watch_seconds", T.IntegerType()),
        T.StructField("event_timestamp", T.TimestampType()),
    ]
)


def _parse(spark, values, schema=SMALL):
    df = spark.createDataFrame([(v,) for v in values], "value string")
    return [tuple(r) if r["e"] is not None else None
            for r in df.select(wire.parse_json(F.col("value"), schema).alias("e")).collect()]


def test_s1_s2_permissive_parse(spark):
    rows = spark.createDataFrame(
        [(None,), ("not json",), ("[]",), ('{"watch_seconds":1}',),
         ('{"event_id":"b","watch_seconds":"x","event_timestamp":"2024-01-01T05:30:00+05:30"}',),
         ('{"event_id":"c","extra":1,"watch_seconds":3.7}',),
         ('{"event_id":"","watch_seconds":-5}',)],
        "value string",
    ).select(wire.parse_json(F.col("value"), SMALL).alias("e")).collect()
    got = [None if r["e"] is None else tuple(r["e"]) for r in rows]
    assert got[0] is None
    assert got[1] == (None, None, None)
    assert got[2] == (None, None, None)
    assert got[3] == (None, 1, None)
    assert got[4] == ("b", None, dt.datetime(2024, 1, 1, 0, 0, 0))  # UTC session, naive UTC
    assert got[5] == ("c", None, None)
    assert got[6] == ("", -5, None)


def test_s2_empty_event_id_passes_not_null_filter(spark):
    df = spark.createDataFrame([("",), (None,)], "event_id string")
    assert quality.drop_unparsed(df).count() == 1


def _bronze_rows(spark, rows):
    schema = ("kafka_key string, kafka_partition int, kafka_offset long, kafka_timestamp timestamp, "
              + ", ".join(f"{c} {t}" for c, t in [
                  ("event_id", "string"), ("user_id", "string"), ("session_id", "string"),
                  ("content_id", "string"), ("content_type", "string"), ("event_type", "string"),
                  ("watch_seconds", "int"), ("playback_position_seconds", "int"), ("device_type", "string"),
                  ("app_version", "string"), ("country_code", "string"), ("event_timestamp", "timestamp")]))
    return spark.createDataFrame(rows, schema)


def _ev(eid, part, off, ts, user="u", sess="s", etype="play", watch=0, country="IN", device="web",
        content="c", version="1.0.0"):
    return ("k", part, off, ts, eid, user, sess, content, "movie", etype, watch, None, device, version,
            country, ts)


def test_s3_dedupe_keeps_lowest_partition_offset(spark):
    t = dt.datetime(2024, 1, 1, 10)
    df = _bronze_rows(spark, [_ev("a", 1, 9, t, watch=3), _ev("a", 0, 50, t, watch=2), _ev("a", 1, 3, t, watch=1),
                              _ev("b", 2, 7, t)])
    out = {r["event_id"]: (r["kafka_partition"], r["kafka_offset"], r["watch_seconds"])
           for r in quality.dedupe_events(df).collect()}
    assert out == {"a": (0, 50, 2), "b": (2, 7, 0)}
    # Idempotent.
    assert quality.dedupe_events(quality.dedupe_events(df)).count() == 2


def test_s4_date_and_hour_in_utc(spark):
    df = spark.createDataFrame([('{"event_id":"x","event_timestamp":"2024-01-01T20:00:00-05:00"}',)], "value string")
    ev = wire.flatten_event(df.select(wire.parse_json(F.col("value")).alias("event")))
    r = enrich_silver(ev).collect()[0]
    assert r["event_date"] == dt.date(2024, 1, 2) and r["event_hour"] == 1


def test_s5_null_timestamp_is_its_own_group(spark):
    t = dt.datetime(2024, 1, 1, 10)
    df = enrich_silver(_bronze_rows(spark, [_ev("a", 0, 1, t), _ev("b", 0, 2, None)]))
    g3 = {(r["event_date"], r["event_hour"]): r["event_count"] for r in gold.hourly_event_distribution(df).collect()}
    assert g3 == {(dt.date(2024, 1, 1), 10): 1, (None, None): 1}


def test_s7_session_grain_has_six_columns(spark):
    t = dt.datetime(2024, 1, 1, 10)
    df = enrich_silver(_bronze_rows(spark, [_ev("a", 0, 1, t, device="web"), _ev("b", 0, 2, t, device="tablet")]))
    assert gold.user_session_summary(df).count() == 2


def test_s10_search_is_case_insensitive_regex_null_safe(spark):
    g5 = spark.createDataFrame([("U-12", "s-1"), ("u.1", "s-2"), (None, "S-U13")], "user_id string, session_id string")
    assert serving.search_sessions(g5, "u.1").count() == 2  # regex: '.' matches '-' in U-12
    assert serving.search_sessions(g5, "u.1", literal=True).count() == 1
    assert serving.search_sessions(g5, "").count() == 3  # empty search keeps all
    assert serving.search_sessions(g5, "s-u1").count() == 1  # NULL user_id is no match, session matches


def test_s11_empty_country_selection_means_all(spark):
    g1 = spark.createDataFrame([("IN", 5), ("US", 2)], "country_code string, total_watch_seconds long")
    assert serving.filter_countries(g1, []).count() == 2
    assert serving.filter_countries(g1, ["US"]).count() == 1


def test_s15_null_semantics_of_aggregates(spark):
    t = dt.datetime(2024, 1, 1, 10)
    rows = [_ev("a", 0, 1, t, user=None, watch=None), _ev("b", 0, 2, t, user=None, watch=None)]
    g1 = gold.daily_watch_time_by_country(enrich_silver(_bronze_rows(spark, rows))).collect()[0]
    assert g1["total_watch_seconds"] is None and g1["unique_users"] == 0 and g1["event_count"] == 2


def test_a1_reference_sanity_rows(spark):
    rows = [("u001", "play", 120), ("u001", "pause", 0), ("u001", "play", 60), ("u002", "play", 300),
            ("u002", "skip", 0), ("u003", "play", 450), ("u003", "play", 200)]
    df = spark.createDataFrame(rows, ["user_id", "event_type", "watch_seconds"])
    got = sorted(tuple(r) for r in gold.watch_per_user(df).collect())
    assert got == [("u001", 180, 3), ("u002", 300, 2), ("u003", 650, 2)]


def test_q7_share_is_double(spark):
    g4 = spark.createDataFrame([("web", 1), ("tablet", 2)], "device_type string, event_count long")
    out = serving.device_share(g4)
    assert dict(out.dtypes)["share"] == "double"
    assert {r["device_type"]: r["share"] for r in out.collect()} == {"web": 33.3, "tablet": 66.7}


def test_top_content_tie_break_is_deterministic(spark):
    g2 = spark.createDataFrame([("c2", "movie", 10), ("c1", "movie", 10), ("c3", "live", 5)],
                               "content_id string, content_type string, total_watch_seconds long")
    assert [r["content_id"] for r in serving.top_content(g2, 2).collect()] == ["c1", "c2"]


def test_event_columns_fixed():
    assert len(EVENT_COLUMNS) == 12


def test_s16_raw_value_only_for_unparsed_messages(spark):
    df = spark.createDataFrame(
        [(b"k", b'{"event_id":"a"}', "t", 0, 1, dt.datetime(2024, 1, 1)),
         (b"k", b"not json", "t", 0, 2, dt.datetime(2024, 1, 1))],
        "key binary, value binary, topic string, partition int, offset long, timestamp timestamp",
    )
    got = {r["kafka_offset"]: r["raw_value"] for r in wire.bronze_from_wire(df, keep_raw_value=True).collect()}
    assert got == {1: None, 2: "not json"}
    assert "raw_value" not in wire.bronze_from_wire(df).columns


def test_s12_top_n_any_n_and_s13_optional_date_range(spark):
    import pytest

    g2 = spark.createDataFrame([(f"c{i}", "movie", i) for i in range(60)],
                               "content_id string, content_type string, total_watch_seconds long")
    assert serving.top_content(g2, 1).collect()[0]["content_id"] == "c59"
    assert serving.top_content(g2, 50).count() == 50
    with pytest.raises(ValueError):
        serving.top_content(g2, 0)
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    g1 = spark.createDataFrame([(d1, "IN", 5), (d2, "IN", 7), (d2, "US", 1)],
                               "event_date date, country_code string, total_watch_seconds long")
    assert {r["country_code"]: r["watch_time"] for r in serving.watch_time_by_country(g1).collect()} == \
        {"IN": 12, "US": 1}
    ranged = serving.watch_time_by_country(g1, date_from="2024-01-02", date_to="2024-01-02")
    assert {r["country_code"]: r["watch_time"] for r in ranged.collect()} == {"IN": 7, "US": 1}


def test_s8_content_grain_two_levels(spark):
    silver = spark.createDataFrame(
        [("c1", "movie", "u", "s", 5), ("c1", "trailer", "u", "s", 3)],
        "content_id string, content_type string, user_id string, session_id string, watch_seconds int",
    )
    g2 = gold.top_content_by_watch_time(silver)
    assert g2.count() == 2
    assert [tuple(r) for r in serving.top_content(g2, 10).collect()] == [("c1", 8)]
