"""Serving queries on the Gold tables: Q1-Q7 with the filters F4 and F5.

The dashboards of the reference pull whole result sets to one machine and
filter there; here the filters run in Spark before anything is collected.
Every top-k has a key tie-break so the LIMIT is deterministic (S9).
"""

from __future__ import annotations

from typing import Iterable, Optional

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import contains_ci, round_avg


def filter_countries(df: DataFrame, countries: Optional[Iterable[str]] = None) -> DataFrame:
    """IN-list on country_code; an empty selection means no filter."""
    sel = list(countries or [])
    return df if not sel else df.filter(F.col("country_code").isin(sel))


def search_sessions(df: DataFrame, search: str = "", literal: bool = False) -> DataFrame:
    """user_id or session_id matches ``search`` (case-insensitive regex,
    NULL = no match, S10). Empty search keeps every row."""
    if not search:
        return df
    return df.filter(contains_ci("user_id", search, literal) | contains_ci("session_id", search, literal))


def kpi_overview(g5: DataFrame) -> DataFrame:
    """Q1: one global aggregate over the session summary."""
    return g5.agg(
        F.count(F.lit(1)).alias("total_sessions"),
        F.count_distinct("user_id").alias("unique_users"),
        F.sum("event_count").cast("long").alias("total_events"),
        round_avg("max_watch_seconds", 1).alias("avg_watch_sec"),
    )


def watch_time_by_country(g1: DataFrame, countries: Optional[Iterable[str]] = None,
                          date_from=None, date_to=None) -> DataFrame:
    """Q2: G1 regrouped by country over all days (S13), optional date range,
    descending, country as tie-break. F4 is applied before the aggregate."""
    df = filter_countries(g1, countries)
    if date_from is not None:
        df = df.filter(F.col("event_date") >= F.lit(date_from).cast("date"))
    if date_to is not None:
        df = df.filter(F.col("event_date") <= F.lit(date_to).cast("date"))
    return (
        df.groupBy("country_code")
        .agg(F.sum("total_watch_seconds").cast("long").alias("watch_time"))
        .orderBy(F.desc("watch_time"), F.col("country_code").asc_nulls_last())
    )


def top_content(g2: DataFrame, n: int = 10) -> DataFrame:
    """Q3: content regrouped by content_id (S8), top n by watch time.
    ``orderBy().limit()`` plans as TakeOrderedAndProject: each task keeps its
    own n best rows, only n x tasks rows reach the final merge."""
    if n < 1:
        raise ValueError("n must be >= 1")
    return (
        g2.groupBy("content_id")
        .agg(F.sum("total_watch_seconds").cast("long").alias("watch_time"))
        .orderBy(F.desc("watch_time"), F.col("content_id").asc_nulls_last())
        .limit(n)
    )


def device_event_mix(g4: DataFrame) -> DataFrame:
    """Q4: events per device type, descending."""
    return (
        g4.groupBy("device_type")
        .agg(F.sum("event_count").cast("long").alias("events"))
        .orderBy(F.desc("events"), F.col("device_type").asc_nulls_last())
    )


# Display names of the device breakdown table (fixed values).
DEVICE_DISPLAY = {"device_type": "Device", "events": "Events"}


def device_breakdown(g4: DataFrame) -> DataFrame:
    """Q4 with display names (P8), as the dashboard's breakdown table shows it."""
    from .enrich import rename_display

    return rename_display(device_event_mix(g4), DEVICE_DISPLAY)


def event_type_distribution(g3: DataFrame) -> DataFrame:
    """Q5: events per event type, descending."""
    return (
        g3.groupBy("event_type")
        .agg(F.sum("event_count").cast("long").alias("events"))
        .orderBy(F.desc("events"), F.col("event_type").asc_nulls_last())
    )


SESSION_EXPLORER_COLUMNS = (
    "session_id",
    "user_id",
    "country_code",
    "device_type",
    "content_type",
    "event_count",
    "max_watch_seconds",
    "session_start",
    "session_end",
)


def session_explorer(g5: DataFrame, search: str = "", literal: bool = False) -> DataFrame:
    """Q6: nine columns of the session summary, newest first, filtered by F5."""
    return (
        search_sessions(g5, search, literal)
        .select(*SESSION_EXPLORER_COLUMNS)
        .orderBy(F.col("session_start").desc_nulls_last(), F.col("session_id"), F.col("user_id"))
    )


def session_match_count(g5: DataFrame, search: str = "", literal: bool = False) -> DataFrame:
    """F5's "N sessions matched", computed in Spark."""
    return search_sessions(g5, search, literal).agg(F.count(F.lit(1)).alias("sessions_matched"))


def device_share(g4: DataFrame) -> DataFrame:
    """Q7: Q4 plus the percent of all events, rounded to one decimal.

    The total is a scalar subquery (a global aggregate, partial per task, one
    value handed to every task), so no row of Q4 is moved to one partition
    and nothing is cross-joined, whatever the number of device types. The
    share is computed in double (a decimal literal would give decimal(26,1)).
    """
    mix = g4.groupBy("device_type").agg(F.sum("event_count").cast("long").alias("events"))
    total = g4.select(F.sum("event_count").cast("double")).scalar()
    return mix.select(
        "device_type",
        "events",
        F.round(F.lit(100.0).cast("double") * F.col("events").cast("double") / total, 1).alias("share"),
    ).orderBy(F.desc("events"), F.col("device_type").asc_nulls_last())
