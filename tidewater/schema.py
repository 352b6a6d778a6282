"""The one definition of the event contract (section 1.2 of the survey).

Every layer schema is derived from ``EVENT_SCHEMA``; validation rules (V1) hang
on the same field list so the contract cannot drift between parse and check.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# They must equal the producer contract for results to match.
# ---------------------------------------------------------------------------
EVENT_TYPES = ("play", "pause", "resume", "skip", "seek", "complete", "error")
DEVICE_TYPES = ("mobile_ios", "mobile_android", "web", "smart_tv", "tablet")
TERMINAL_EVENT_TYPES = ("complete", "error")
MAX_SECONDS = 86400
# Field name -> (min length, max length) for string fields of the contract.
LENGTH_RULES = {
    "event_id": (36, 36),
    "user_id": (1, 64),
    "session_id": (1, 64),
    "content_id": (1, 64),
    "content_type": (1, 32),
    "app_version": (1, 32),
    "country_code": (2, 2),
}
# Integer fields with an inclusive range.
RANGE_RULES = {
    "watch_seconds": ("watch_seconds_range", 0, MAX_SECONDS),
    "playback_position_seconds": ("position_range", 0, MAX_SECONDS),
}
# Enumerated fields.
ENUM_RULES = {
    "event_type": ("event_type_unknown", EVENT_TYPES),
    "device_type": ("device_type_unknown", DEVICE_TYPES),
}
# Fields that must be present. watch_seconds has a default (0) and
# playback_position_seconds is optional, so neither raises "_missing".
REQUIRED_FIELDS = (
    "event_id",
    "user_id",
    "session_id",
    "content_id",
    "content_type",
    "event_type",
    "device_type",
    "app_version",
    "country_code",
    "event_timestamp",
)
# JSON timestamp format on the wire: microseconds and an explicit offset.
WIRE_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
# Fields of an event: name, type, declared nullability.
EVENT_FIELDS = (
    ("event_id", T.StringType(), False),
    ("user_id", T.StringType(), False),
    ("session_id", T.StringType(), False),
    ("content_id", T.StringType(), False),
    ("content_type", T.StringType(), False),
    ("event_type", T.StringType(), False),
    ("watch_seconds", T.IntegerType(), False),
    ("playback_position_seconds", T.IntegerType(), True),
    ("device_type", T.StringType(), False),
    ("app_version", T.StringType(), False),
    ("country_code", T.StringType(), False),
    ("event_timestamp", T.TimestampType(), False),
)
# ---------------------------------------------------------------------------

# Declared nullability is documentation only: from_json makes every field
# nullable (S1), so the check lives in V1, not in the schema.
EVENT_SCHEMA = T.StructType([T.StructField(n, t, nullable) for n, t, nullable in EVENT_FIELDS])
EVENT_COLUMNS = tuple(n for n, _, _ in EVENT_FIELDS)

# Kafka record layout (the columns of the Kafka source we use).
WIRE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType(), True),
        T.StructField("value", T.BinaryType(), True),
        T.StructField("topic", T.StringType(), True),
        T.StructField("partition", T.IntegerType(), True),
        T.StructField("offset", T.LongType(), True),
        T.StructField("timestamp", T.TimestampType(), True),
    ]
)

KAFKA_COLUMNS = ("kafka_key", "kafka_partition", "kafka_offset", "kafka_timestamp")
BRONZE_COLUMNS = KAFKA_COLUMNS + EVENT_COLUMNS + ("ingested_at",)
SILVER_COLUMNS = BRONZE_COLUMNS + ("event_date", "event_hour", "transformed_at")
#: Stored Bronze rows; readers name it, so reading lists folders and opens no file for its schema.
BRONZE_SCHEMA = T.StructType(
    [
        T.StructField("kafka_key", T.StringType()),
        T.StructField("kafka_partition", T.IntegerType()),
        T.StructField("kafka_offset", T.LongType()),
        T.StructField("kafka_timestamp", T.TimestampType()),
        *[T.StructField(n, t) for n, t, _ in EVENT_FIELDS],
        T.StructField("ingested_at", T.TimestampType()),
    ]
)
BRONZE_DDL = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in BRONZE_SCHEMA)
