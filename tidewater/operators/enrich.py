"""Projections: P4 stamps, P5 event_date, P6 event_hour, P7 upper_columns,
P8 rename_display, P9 normalise_event."""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import audit_time


def stamp_ingested(df: DataFrame, clock=None) -> DataFrame:
    return df.withColumn("ingested_at", audit_time(clock))


def stamp_transformed(df: DataFrame, clock=None) -> DataFrame:
    return df.withColumn("transformed_at", audit_time(clock))


def with_event_date(df: DataFrame) -> DataFrame:
    """P5: date of the event in the session zone (UTC, S4); NULL stays NULL."""
    return df.withColumn("event_date", F.to_date("event_timestamp"))


def with_event_hour(df: DataFrame) -> DataFrame:
    """Hour 0..23 of the event time."""
    return df.withColumn("event_hour", F.hour("event_timestamp"))


def enrich_silver(df: DataFrame, clock=None) -> DataFrame:
    """P5 + P6 + P4 in one projection."""
    return df.withColumns(
        {
            "event_date": F.to_date("event_timestamp"),
            "event_hour": F.hour("event_timestamp"),
            "transformed_at": audit_time(clock),
        }
    )


def upper_columns(df: DataFrame) -> DataFrame:
    """All column names to upper case (warehouse convention)."""
    return df.toDF(*[c.upper() for c in df.columns])


def rename_display(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns for display."""
    return df.withColumnsRenamed(dict(mapping))


def normalise_event(df: DataFrame) -> DataFrame:
    """The producer's normalisation as column expressions.

    Country code to upper case, a missing watch_seconds to its default 0.
    Timestamps are already UTC instants: the JSON parse converts any offset and
    the session zone is UTC.
    """
    return df.withColumns(
        {
            "country_code": F.upper("country_code"),
            "watch_seconds": F.coalesce(F.col("watch_seconds"), F.lit(0)),
        }
    )
