"""Wire <-> event conversions: P1 kafka_metadata, P2 parse_json, P3 flatten_event,
SNK6 to_wire, and the Bronze projection that chains them.

All functions are plain ``DataFrame -> DataFrame`` (or ``Column``) so the same
code serves a batch replay and a streaming micro-batch.
"""

from __future__ import annotations

from typing import Optional

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .enrich import stamp_ingested
from ..schema import EVENT_COLUMNS, EVENT_SCHEMA, WIRE_TIMESTAMP_FORMAT


def kafka_metadata() -> list:
    """Key as text plus partition, offset and broker time, renamed kafka_*."""
    return [
        F.col("key").cast("string").alias("kafka_key"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
    ]


def parse_json(value: Column, schema: StructType = EVENT_SCHEMA) -> Column:
    """Permissive parse of the message text into the event struct.

    Non-JSON text gives a struct of NULLs, a NULL value a NULL struct, and a
    field of the wrong type is NULL on its own. Timestamps with an offset are
    converted to the session zone (UTC).
    """
    return F.from_json(value.cast("string"), schema)


def flatten_event(df: DataFrame, struct_col: str = "event") -> DataFrame:
    """Struct -> top-level columns."""
    others = [c for c in df.columns if c != struct_col]
    return df.select(*others, f"{struct_col}.*")


def bronze_from_wire(
    wire: DataFrame,
    clock=None,
    keep_raw_value: bool = False,
    schema: StructType = EVENT_SCHEMA,
    wire_bytes: Optional[str] = None,
) -> DataFrame:
    """PL1 projection: wire records -> Bronze rows (17 columns, S16 optional 18th).

    A narrow projection only: no shuffle, so it runs per micro-batch and per
    Kafka partition in parallel. ``wire_bytes`` names an extra column with the
    message size, for metrics taken on the same pass (the value is parsed
    once).
    """
    cols = kafka_metadata() + [parse_json(F.col("value"), schema).alias("event")]
    if wire_bytes:
        cols.append(F.octet_length("value").alias(wire_bytes))
    if keep_raw_value:
        cols.append(F.col("value").cast("string").alias("_raw"))
    parsed = flatten_event(wire.select(*cols))
    out = stamp_ingested(parsed, clock)
    if keep_raw_value:
        out = out.withColumn(
            "raw_value", F.when(F.col("event_id").isNull(), F.col("_raw"))
        ).drop("_raw")
    return out


def event_json() -> Column:
    """The twelve event columns as JSON text, a NULL field as an explicit null.

    The timestamp keeps microseconds and an explicit offset; the default JSON
    format would truncate to milliseconds and break the round trip.
    """
    return F.to_json(
        F.struct(*[F.col(c) for c in EVENT_COLUMNS]),
        {"timestampFormat": WIRE_TIMESTAMP_FORMAT, "ignoreNullFields": "false"},
    )


def to_wire(events: DataFrame) -> DataFrame:
    """SNK6: event rows -> (key = user_id, value = JSON text); a NULL user_id raises."""
    # A message without a key would lose its place in the user's order.
    key = F.coalesce(F.col("user_id"), F.raise_error(F.lit("to_wire: user_id is NULL; quarantine such events first")).cast("string"))
    return events.select(key.alias("key"), event_json().alias("value"))


def from_wire_text(df: DataFrame, value: str = "value") -> DataFrame:
    """Inverse of ``to_wire`` for text values: JSON -> event columns."""
    return flatten_event(df.select(parse_json(F.col(value)).alias("event")))
