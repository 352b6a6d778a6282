"""Canonical events and wire messages derived by Spark from the given tables.

The supplied ``events`` table (event_id, ts, user_id, event_type, value,
props) is mapped onto the 12-field event contract. The mapping rules are fixed
values shared with the DuckDB oracle (``tidewater.oracle``), so both engines
derive identical rows from the same parquet file.

Everything here is a DataFrame transformation: no rows pass through the driver
and the work grows with the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.windows import cumulative_sum
from .operators.wire import event_json
from .schema import EVENT_COLUMNS, MAX_SECONDS

# ---------------------------------------------------------------------------
# Fixed values of the fixture mapping.
# ---------------------------------------------------------------------------
# Source event_type -> contract event_type.
EVENT_TYPE_MAP = {
    "view": "play",
    "click": "seek",
    "purchase": "complete",
    "signup": "resume",
    "error": "error",
}
# Wire generation: a producer retry when id % 20 = 0, a junk text when
# id % 50 = 0, Kafka partition = user_id % 6, offset = id * 10 + copy.
RETRY_EVERY = 20
JUNK_EVERY = 50
# A session is a user's events of 48 hours from noon to noon, so it crosses
# one midnight or two.
SESSION_SECONDS = 172_800
SESSION_SHIFT = 43_200
# Rows that break one rule of the contract or hold a special value: the value
# stands where event id modulo the number is 0.
CASES = {
    "no_watch": 7,  # (user id + day of month): the whole day without watch_seconds
    "second_type": 37,
    "second_device": 41,
    "unknown_device": 43,
    "no_event_type": 83,
    "unknown_event_type": 89,
    "negative_watch": 97,
    "empty_user": 101,
    "long_session": 103,
    "long_content": 107,
    "empty_content_type": 109,
    "long_version": 113,
    "long_country": 127,
    "position_beyond": 131,
    "naive_timestamp": 137,  # on the wire only
    "ill_typed_watch": 139,  # on the wire; NULL after the parse
    "accented_content": 149,
}
JUNK_TEXT = "not json"
TOPIC_PARTITIONS = 6
TOPIC = "user_events"
# ---------------------------------------------------------------------------


def _content_type(ck: Column) -> Column:
    m = ck % 20
    return (
        F.when(m < 11, "series_episode")
        .when(m < 17, "movie")
        .when(m == 17, "short")
        .when(m == 18, "trailer")
        .otherwise("live")
    )


def _device_type(uid: Column) -> Column:
    m = uid % 20
    return (
        F.when(m < 9, "mobile_android")
        .when(m < 12, "mobile_ios")
        .when(m < 16, "smart_tv")
        .when(m < 18, "web")
        .otherwise("tablet")
    )


def _country_code(uid: Column) -> Column:
    m = uid % 20
    return (
        F.when(m < 11, "IN")
        .when(m < 13, "US")
        .when(m == 13, "GB")
        .when(m == 14, "AE")
        .when(m == 15, "SG")
        .when(m == 16, "CA")
        .when(m == 17, "AU")
        .when(m == 18, "DE")
        .otherwise("BD")
    )


def _case(name: str) -> Column:
    return F.col("src_id") % CASES[name] == 0


def _event_type(src: Column) -> Column:
    expr = (
        F.when(_case("no_event_type"), F.lit(None).cast("string"))
        .when(_case("unknown_event_type"), "buffer")
        .when((src == "click") & (F.col("src_id") % 3 == 1), "pause")
        .when((src == "view") & (F.col("src_id") % 5 == 1), "skip")
    )
    for k, v in EVENT_TYPE_MAP.items():
        expr = expr.when(src == k, v)
    return expr


def canonical_from_source(src: DataFrame) -> DataFrame:
    """Map the supplied ``events`` rows onto the event contract.

    Keeps ``src_id`` and ``src_user`` (the numeric ids) for wire generation.
    """
    ts = F.col("ts").cast("timestamp")  # session zone is UTC: same wall clock
    base = src.select(
        F.col("event_id").alias("src_id"),
        F.col("user_id").alias("src_user"),
        ts.alias("event_timestamp"),
        F.floor((F.unix_seconds(ts) + SESSION_SHIFT) / SESSION_SECONDS).alias("_s"),
        F.dayofmonth(ts).alias("_day"),
        F.col("event_type").alias("_src_type"),
        F.floor(F.col("value")).cast("int").alias("_v"),
    )
    cum = cumulative_sum(
        base,
        keys=["src_user", "_s"],
        ts="event_timestamp",
        tie="src_id",
        value="_v",
        out="_cum",
    )
    ck = (F.col("src_user") * 7 + F.col("_day")) % 100
    return cum.select(
        "src_id",
        "src_user",
        F.concat(F.lit("e-"), F.col("src_id").cast("string")).alias("event_id"),
        F.when(_case("empty_user"), "")
        .otherwise(F.concat(F.when(F.col("src_user") % 50 == 13, "u-\u00c9").otherwise("u-"), F.col("src_user").cast("string")))
        .alias("user_id"),
        F.when(_case("long_session"), "s" * 65)
        .otherwise(F.concat(F.lit("s-"), F.col("src_user").cast("string"), F.lit("-"), F.col("_s").cast("string")))
        .alias("session_id"),
        F.when(_case("long_content"), "c" * 65)
        .otherwise(F.concat(F.when(_case("accented_content"), "c-\u00e9").otherwise("c-"), ck.cast("string")))
        .alias("content_id"),
        F.when(_case("empty_content_type"), "")
        .when(_case("second_type"), "trailer")
        .otherwise(_content_type(ck))
        .alias("content_type"),
        _event_type(F.col("_src_type")).alias("event_type"),
        F.when(_case("ill_typed_watch") | ((F.col("src_user") + F.col("_day")) % CASES["no_watch"] == 0), F.lit(None).cast("int"))
        .when(_case("negative_watch"), -5)
        .otherwise(F.least(F.lit(MAX_SECONDS), F.col("_cum")).cast("int"))
        .alias("watch_seconds"),
        F.when(_case("position_beyond"), MAX_SECONDS + 1)
        .when(F.col("src_id") % 10 == 0, F.lit(None).cast("int"))
        .otherwise(F.col("_v"))
        .alias("playback_position_seconds"),
        F.when(_case("unknown_device"), "fridge")
        .when(_case("second_device"), "web")
        .otherwise(_device_type(F.col("src_user")))
        .alias("device_type"),
        F.when(_case("long_version"), "9" * 33)
        .otherwise(F.concat(F.lit("1."), (F.col("src_id") % 5).cast("string"), F.lit(".0")))
        .alias("app_version"),
        F.when(_case("long_country"), "IND")
        .when((F.col("src_user") % 20 == 18) & (F.col("src_id") % 2 == 0), "de")
        .otherwise(_country_code(F.col("src_user")))
        .alias("country_code"),
        "event_timestamp",
    )


def read_source_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def canonical_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 12 contract columns, one row per supplied event."""
    return canonical_from_source(read_source_events(spark, sf_dir)).select(*EVENT_COLUMNS)


def wire_from_canonical(canon: DataFrame) -> DataFrame:
    """Kafka records for the canonical rows: key = user_id, JSON value.

    One message per event, a retry copy for every 20th id and a junk message
    for every 50th. Copies are generated with ``explode`` (narrow, no shuffle).
    """
    copies = F.filter(
        F.array(F.lit(0), F.lit(1), F.lit(2)),
        lambda c: (c == 0)
        | ((c == 1) & (F.col("src_id") % RETRY_EVERY == 0))
        | ((c == 2) & (F.col("src_id") % JUNK_EVERY == 0)),
    )
    payload = event_json()
    # Messages of producers that break the contract in the text itself.
    payload = F.when(_case("naive_timestamp"), F.regexp_replace(payload, 'Z"\\}$', '"}')).otherwise(payload)
    payload = F.when(
        _case("ill_typed_watch"), F.replace(payload, F.lit('"watch_seconds":null'), F.lit('"watch_seconds":"bad"'))
    ).otherwise(payload)
    return canon.select("*", F.explode(copies).alias("_copy")).select(
        F.col("user_id").cast("binary").alias("key"),
        F.when(F.col("_copy") == 2, F.lit(JUNK_TEXT)).otherwise(payload).cast("binary").alias("value"),
        F.lit(TOPIC).alias("topic"),
        (F.col("src_user") % TOPIC_PARTITIONS).cast("int").alias("partition"),
        (F.col("src_id") * 10 + F.col("_copy")).cast("long").alias("offset"),
        (F.col("event_timestamp") + F.make_interval(secs=F.col("_copy").cast("decimal(18,6)"))).alias(
            "timestamp"
        ),
    )


def wire_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wire table (key, value, topic, partition, offset, timestamp)."""
    return wire_from_canonical(canonical_from_source(read_source_events(spark, sf_dir)))
