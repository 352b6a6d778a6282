"""Gold aggregates G1-G5, G1b and A1 over Silver rows.

Each is one hash group-by with map-side partial aggregation. The two exact
distinct counts in G1, G2 and G4 are planned by Catalyst with an Expand into
(keys, user_id) and (keys, session_id) groups that are themselves partially
aggregated, so a hot (key, user) pair collapses before the shuffle.

Sorting is a separate, optional step (``ordered``): the order of a written
multi-file table is not a contract, so the build writes unsorted (one shuffle
less) and readers sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _events() -> Column:
    return F.count(F.lit(1)).alias("event_count")


def daily_watch_time_by_country(silver: DataFrame) -> DataFrame:
    """G1: per (event_date, country_code). total_watch_seconds sums a
    cumulative field and over-counts on purpose (S6); see G1b."""
    return silver.groupBy("event_date", "country_code").agg(
        F.sum("watch_seconds").cast("long").alias("total_watch_seconds"),
        F.count_distinct("user_id").alias("unique_users"),
        F.count_distinct("session_id").alias("unique_sessions"),
        _events(),
    )


def top_content_by_watch_time(silver: DataFrame) -> DataFrame:
    """Per (content_id, content_type), all time."""
    return silver.groupBy("content_id", "content_type").agg(
        F.sum("watch_seconds").cast("long").alias("total_watch_seconds"),
        F.count_distinct("user_id").alias("unique_viewers"),
        F.count_distinct("session_id").alias("unique_sessions"),
        _events(),
    )


def hourly_event_distribution(silver: DataFrame) -> DataFrame:
    """Events per (event_date, event_hour, event_type)."""
    return silver.groupBy("event_date", "event_hour", "event_type").agg(_events())


def daily_device_mix(silver: DataFrame) -> DataFrame:
    """Per (event_date, device_type)."""
    return silver.groupBy("event_date", "device_type").agg(
        F.count_distinct("user_id").alias("unique_users"),
        F.count_distinct("session_id").alias("unique_sessions"),
        _events(),
    )


SESSION_KEYS = ("session_id", "user_id", "content_id", "content_type", "device_type", "country_code")


def user_session_summary(silver: DataFrame) -> DataFrame:
    """One row per session grain of six columns."""
    return silver.groupBy(*SESSION_KEYS).agg(
        F.min("event_timestamp").alias("session_start"),
        F.max("event_timestamp").alias("session_end"),
        F.max("watch_seconds").alias("max_watch_seconds"),
        _events(),
    )


def daily_watch_time_accurate(silver: DataFrame) -> DataFrame:
    """Watch time without the cumulative over-count.

    Per (session_id, country_code, event_date) the day's max(watch_seconds)
    minus the same session's last known max on an earlier day (0 if none), summed per
    (event_date, country_code). Two aggregates; the window runs over the
    per-session-day rows (a handful per session), never over raw events.
    """
    daily = silver.groupBy("session_id", "country_code", "event_date").agg(
        F.max("watch_seconds").alias("_m")
    )
    w = Window.partitionBy("session_id", "country_code").orderBy(F.col("event_date").asc_nulls_first())
    before = F.last("_m", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    delta = daily.withColumn("_d", F.col("_m") - F.coalesce(before, F.lit(0)))
    return delta.groupBy("event_date", "country_code").agg(
        F.sum("_d").cast("long").alias("total_watch_seconds")
    )


def watch_per_user(events: DataFrame) -> DataFrame:
    """A1: total watch seconds and events per user."""
    return events.groupBy("user_id").agg(
        F.sum("watch_seconds").cast("long").alias("total_watch_seconds"),
        _events(),
    )


# Reader-side order of each Gold table, with key tie-breaks (S9):
# (column, descending) pairs; NULL dates sort first as in Spark's ascending order.
GOLD_ORDER = {
    "daily_watch_time_by_country": [("event_date", False), ("total_watch_seconds", True), ("country_code", False)],
    "top_content_by_watch_time": [("total_watch_seconds", True), ("content_id", False), ("content_type", False)],
    "hourly_event_distribution": [("event_date", False), ("event_hour", False), ("event_type", False)],
    "daily_device_mix": [("event_date", False), ("unique_sessions", True), ("device_type", False)],
    "user_session_summary": [("max_watch_seconds", True), ("session_id", False), ("user_id", False),
                             ("content_id", False), ("content_type", False), ("device_type", False),
                             ("country_code", False)],
}

GOLD_BUILDERS = {
    "daily_watch_time_by_country": daily_watch_time_by_country,
    "top_content_by_watch_time": top_content_by_watch_time,
    "hourly_event_distribution": hourly_event_distribution,
    "daily_device_mix": daily_device_mix,
    "user_session_summary": user_session_summary,
}

# Silver columns each Gold table reads: the shared scan keeps only these.
GOLD_INPUT_COLUMNS = (
    "event_date",
    "event_hour",
    "event_type",
    "country_code",
    "content_id",
    "content_type",
    "device_type",
    "session_id",
    "user_id",
    "watch_seconds",
    "event_timestamp",
)


# ---------------------------------------------------------------------------
# Shared rollup for the Gold build
# ---------------------------------------------------------------------------

# Session-day grain: every key G1, G2, G4 and G5 group by is a column of it.
ROLLUP_KEYS = ("event_date",) + SESSION_KEYS


def session_day_rollup(silver: DataFrame) -> DataFrame:
    """Silver rolled up per (event_date + the six session keys).

    Sums, counts, minima and maxima re-aggregate exactly, and every distinct
    user or session of a G1/G2/G4 group is present as a rollup row, so those
    tables and G5 come out identical when computed from this rollup (NULLs
    included: a NULL key is its own group in both, a sum of NULLs stays
    NULL). One partial aggregate over Silver: rows of a session-day sit
    together in the range-clustered Silver files, so most of the reduction
    happens map-side, and a hot session collapses there too.
    """
    return silver.groupBy(*ROLLUP_KEYS).agg(
        F.sum("watch_seconds").alias("r_watch"),
        F.count(F.lit(1)).alias("r_events"),
        F.min("event_timestamp").alias("r_start"),
        F.max("event_timestamp").alias("r_end"),
        F.max("watch_seconds").alias("r_max_watch"),
    )


def _distincts_from_rollup(rollup: DataFrame, keys, users_as: str) -> DataFrame:
    return rollup.groupBy(*keys).agg(
        F.sum("r_watch").cast("long").alias("total_watch_seconds"),
        F.count_distinct("user_id").alias(users_as),
        F.count_distinct("session_id").alias("unique_sessions"),
        F.sum("r_events").cast("long").alias("event_count"),
    )


def gold_from_rollup(rollup: DataFrame, silver: DataFrame) -> dict:
    """The five Gold tables: G1, G2, G4, G5 from the rollup, G3 (needs hour
    and event type) from its own three-column Silver scan."""
    g1 = _distincts_from_rollup(rollup, ["event_date", "country_code"], "unique_users")
    g2 = _distincts_from_rollup(rollup, ["content_id", "content_type"], "unique_viewers")
    g4 = _distincts_from_rollup(rollup, ["event_date", "device_type"], "unique_users").drop("total_watch_seconds")
    g5 = rollup.groupBy(*SESSION_KEYS).agg(
        F.min("r_start").alias("session_start"),
        F.max("r_end").alias("session_end"),
        F.max("r_max_watch").alias("max_watch_seconds"),
        F.sum("r_events").cast("long").alias("event_count"),
    )
    return {
        "daily_watch_time_by_country": g1,
        "top_content_by_watch_time": g2,
        "hourly_event_distribution": hourly_event_distribution(silver),
        "daily_device_mix": g4,
        "user_session_summary": g5,
    }


def ordered(df: DataFrame, name: str) -> DataFrame:
    """O1/O2: the reference's sort of a Gold table, with tie-breaks."""
    return df.orderBy(*[F.desc(c) if d else F.asc(c) for c, d in GOLD_ORDER[name]])
