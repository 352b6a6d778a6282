"""PL2 and PL3 by date: late events touch only the partitions of their dates.

``refresh_incremental`` reads the Bronze batches published since the last
refresh, merges them into Silver, notes which dates changed, and rebuilds Gold
for those dates:

- Silver: only partitions of touched dates are rewritten (C2, dynamic partition
  overwrite). A new message that repeats an event already in Silver touches
  nothing unless it wins the dedupe (lower partition and offset); then the dates
  of both rows are touched.
- G1, G3, G4 are partitioned by event_date and rewritten for the touched dates.
- G2 and G5 cover all time: they are merged from partial states kept by date (the
  session-day rollup and, for G2's distinct counts, bitmaps), of which only the
  touched dates are recomputed.

One refresh runs at a time. Every step is a function of what is stored and of the batches not yet consumed;
the batches are marked as consumed last. A refresh that stops anywhere is simply
run again: replacements are finished or undone by ``sinks.swap``, and a second
run over the same batches finds nothing left to change in Silver but still
rebuilds the dates noted in the ledger.
"""

from __future__ import annotations

import datetime as _dt
from typing import Dict, Iterable, List, Optional, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import GOLD_TABLES, SILVER_TABLE, LakeConfig
from ..functions.expr import audit_time
from ..operators.bitmaps import MEMBERS, NUMBERS, daily_states, merged, new_numbers
from ..operators.gold import GOLD_INPUT_COLUMNS, SESSION_KEYS, hourly_event_distribution, session_day_rollup
from ..sinks.storage import committed_versions, filesystem, latest_path, path_exists, read_path, scratch_dir, write_table
from ..sinks.swap import replace_partitions
from ..sinks.tables import write_gold, write_silver
from ..sources.tables import read_bronze_batches
from .layers import silver_from_bronze

CONSUMED = "_consumed_batches"
TOUCHED = "_touched_dates"
#: Tables of the incremental build under the Gold layer: partial states by date, and dense numbers.
ROLLUP, NUMBERED = "_session_days", {kind: f"_{kind}_numbers" for kind in MEMBERS}
STATES = {
    "daily_watch_time_by_country": ("_country_days", ("event_date", "country_code")),
    "top_content_by_watch_time": ("_content_days", ("content_id", "content_type")),
    "daily_device_mix": ("_device_days", ("event_date", "device_type")),
}
DATED = ("daily_watch_time_by_country", "hourly_event_distribution", "daily_device_mix")


def on_dates(dates: Iterable[Optional[_dt.date]]) -> Column:
    """Condition that becomes a partition filter on event_date; None is the NULL date."""
    dates = list(dates)
    known = [d for d in dates if d is not None]
    cond = F.col("event_date").isin(known) if known else F.lit(False)
    return cond | F.col("event_date").isNull() if len(known) < len(dates) else cond


def date_range(first: _dt.date, last: _dt.date) -> List[_dt.date]:
    """The dates from ``first`` to ``last``, both included."""
    return [first + _dt.timedelta(days=i) for i in range((last - first).days + 1)]


def _built(spark: SparkSession, cfg: LakeConfig, path: str) -> bool:
    if cfg.table_format == "delta":
        return path_exists(spark, f"{path}/_delta_log")
    return bool(committed_versions(spark, path))


def _dated(spark: SparkSession, cfg: LakeConfig, path: str) -> DataFrame:
    """A table partitioned by event_date; where all dates are NULL the folders alone don't tell its type."""
    return read_path(spark, cfg, path).withColumn("event_date", F.col("event_date").cast("date"))


def _put(df: DataFrame, cfg: LakeConfig, path: str, dates: Optional[Sequence]) -> None:
    """All of a table partitioned by event_date, or its partitions of ``dates``."""
    if dates is None:
        write_table(df, cfg, path, partition_by=("event_date",), overwrite_schema=True)
    else:
        target = path if cfg.table_format == "delta" else latest_path(df.sparkSession, path)
        replace_partitions(df, target, "event_date", dates, cfg.table_format)


# ---------------------------------------------------------------------------
# Silver
# ---------------------------------------------------------------------------


def _new_batches(spark: SparkSession, cfg: LakeConfig) -> tuple:
    """(Bronze rows of batches not yet consumed, {query: last batch} after them)."""
    bronze = read_bronze_batches(spark, cfg)
    path = cfg.path("silver", CONSUMED)
    done = {r["query"]: r["batch"] for r in read_path(spark, cfg, path).collect()} if _built(spark, cfg, path) else {}
    # One row per stream (checkpoint), from the partition columns alone.
    seen = {r["query"]: r["batch"] for r in bronze.select("query", "batch").distinct().groupBy("query").agg(F.max("batch").alias("batch")).collect()}
    fresh = F.lit(False)
    for query, batch in seen.items():
        fresh = fresh | ((F.col("query") == query) & (F.col("batch") > done.get(query, -1)) & (F.col("batch") <= batch))
    return bronze.filter(fresh).drop("query", "batch"), {**done, **seen}


def merge_silver(spark: SparkSession, cfg: LakeConfig, bronze: DataFrame) -> List[Optional[_dt.date]]:
    """Merges new Bronze rows into Silver; returns the dates whose partitions changed.

    Silver holds the survivor of every event so far, so the new rows need to be
    compared with those alone: one scan of Silver's event_id and message
    position, not of Bronze.
    """
    fresh = silver_from_bronze(bronze, cfg.clock)
    path = cfg.path("silver", SILVER_TABLE)
    if not _built(spark, cfg, path):
        write_silver(fresh, cfg)
        return [r[0] for r in _dated(spark, cfg, path).select("event_date").distinct().collect()]
    silver = _dated(spark, cfg, path)
    old = silver.select("event_id", F.struct("kafka_partition", "kafka_offset").alias("old_place"), F.col("event_date").alias("old_date"))
    place = F.struct("kafka_partition", "kafka_offset")
    changed = fresh.join(old, "event_id", "left").filter(F.col("old_place").isNull() | (place < F.col("old_place")))
    changed = changed.withColumn("replaces", F.col("old_place").isNotNull()).drop("old_place")
    staged = scratch_dir(spark, "silver-changes")
    changed.write.parquet(staged)  # new rows only; pins them while Silver changes
    changed = spark.read.schema(changed.schema).parquet(staged)
    dates = [r[0] for r in changed.select("event_date").unionByName(changed.filter("replaces").select(F.col("old_date").alias("event_date"))).distinct().collect()]
    if dates:
        # The ledger first: should the run stop after Silver changed, Gold is still rebuilt for these dates.
        note_touched(spark, cfg, dates)
        kept = silver.filter(on_dates(dates)).join(changed.filter("replaces").select("event_id"), "event_id", "left_anti")
        rows = kept.unionByName(changed.select(*kept.columns))
        keys = ["event_date", "user_id", "event_timestamp", "event_id"]
        rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
        _put(rows, cfg, path, dates)
    _drop(spark, staged)
    return dates


def _drop(spark: SparkSession, path: str) -> None:
    fs, p = filesystem(spark, path)
    fs.delete(p, True)


def note_touched(spark: SparkSession, cfg: LakeConfig, dates: Iterable) -> None:
    """Adds dates to the ledger of dates that Silver has changed and Gold has not yet seen."""
    both = sorted({*touched_dates(spark, cfg), *dates}, key=lambda d: (d is not None, d or _dt.date.min))
    write_table(spark.createDataFrame([(d,) for d in both], "event_date date").coalesce(1), cfg, cfg.path("silver", TOUCHED))


def touched_dates(spark: SparkSession, cfg: LakeConfig) -> List[Optional[_dt.date]]:
    """The ledger's dates (a calendar bounds them)."""
    path = cfg.path("silver", TOUCHED)
    return [r[0] for r in read_path(spark, cfg, path).collect()] if _built(spark, cfg, path) else []


# ---------------------------------------------------------------------------
# Gold
# ---------------------------------------------------------------------------


def _numbers(spark: SparkSession, cfg: LakeConfig, kind: str, rollup: DataFrame) -> DataFrame:
    """The (id, n) table of ``kind``, with the rollup's new values numbered and appended."""
    path = cfg.path("gold", NUMBERED[kind])
    known = spark.read.schema(NUMBERS).parquet(path) if path_exists(spark, path) else None
    staged = scratch_dir(spark, "numbers")
    new_numbers(rollup, known, staged, MEMBERS[kind]).write.mode("append").parquet(path)
    _drop(spark, staged)
    return spark.read.schema(NUMBERS).parquet(path)


def build_gold_by_date(spark: SparkSession, cfg: LakeConfig, dates: Optional[Iterable] = None) -> Dict[str, int]:
    """PL3 with a date range: Gold for ``dates`` (all of Silver when None or when no state exists yet).

    Silver is read for those dates only. Returns the rows of the tables that are
    rewritten as a whole (G2, G5) and of the rewritten dates (G1, G3, G4).
    """
    path = cfg.path("gold", ROLLUP)
    dates = None if dates is None or not _built(spark, cfg, path) else list(dates)
    if dates is not None and not dates:
        return {}
    here = F.lit(True) if dates is None else on_dates(dates)
    silver = _dated(spark, cfg, cfg.path("silver", SILVER_TABLE)).filter(here).select(*GOLD_INPUT_COLUMNS)
    _put(session_day_rollup(silver), cfg, path, dates)
    rollup = _dated(spark, cfg, path)
    now = rollup.filter(here)
    numbers = {kind: _numbers(spark, cfg, kind, now) for kind in MEMBERS}
    for table, keys in STATES.values():
        _put(daily_states(now, numbers, keys), cfg, cfg.path("gold", table), dates)

    def states(name: str) -> DataFrame:
        return _dated(spark, cfg, cfg.path("gold", STATES[name][0]))

    daily = {
        "daily_watch_time_by_country": merged(states("daily_watch_time_by_country").filter(here), ("event_date", "country_code")),
        "hourly_event_distribution": hourly_event_distribution(silver),
        "daily_device_mix": merged(states("daily_device_mix").filter(here), ("event_date", "device_type")).drop("total_watch_seconds"),
    }
    rows = {}
    for name, df in daily.items():
        # A date's rows of these tables are few: one file for each.
        stamped = df.repartition("event_date").withColumn("transformed_at", audit_time(cfg.clock))
        _put(stamped, cfg, cfg.path("gold", name), dates)
        rows[name] = _dated(spark, cfg, cfg.path("gold", name)).filter(here).count()
    rows["top_content_by_watch_time"] = write_gold(merged(states("top_content_by_watch_time"), ("content_id", "content_type"), "unique_viewers"), cfg, "top_content_by_watch_time")
    sessions = rollup.groupBy(*SESSION_KEYS).agg(
        F.min("r_start").alias("session_start"), F.max("r_end").alias("session_end"),
        F.max("r_max_watch").alias("max_watch_seconds"), F.sum("r_events").cast("long").alias("event_count"),
    )
    rows["user_session_summary"] = write_gold(sessions, cfg, "user_session_summary")
    return {n: rows[n] for n in GOLD_TABLES}


def distinct_over_dates(spark: SparkSession, cfg: LakeConfig, table: str, first: _dt.date, last: _dt.date) -> DataFrame:
    """A Gold table's measures over a range of dates, by its keys without the date: the daily
    bitmaps are OR-ed, so a user of several days counts once, and no event is read."""
    state, keys = STATES[table]
    days = _dated(spark, cfg, cfg.path("gold", state)).filter(F.col("event_date").between(F.lit(first), F.lit(last)))
    return merged(days, [k for k in keys if k != "event_date"])


def refresh_incremental(spark: SparkSession, cfg: LakeConfig) -> Dict[str, object]:
    """New Bronze batches -> Silver -> Gold of the touched dates; the dates and Gold's row counts."""
    fresh, upto = _new_batches(spark, cfg)
    first = not _built(spark, cfg, cfg.path("gold", ROLLUP))
    touched = merge_silver(spark, cfg, fresh)
    dates = None if first else sorted({*touched, *touched_dates(spark, cfg)}, key=lambda d: (d is not None, d or _dt.date.min))
    counts = build_gold_by_date(spark, cfg, dates)
    write_table(spark.createDataFrame(sorted(upto.items()), "query string, batch long").coalesce(1), cfg, cfg.path("silver", CONSUMED))
    write_table(spark.createDataFrame([], "event_date date"), cfg, cfg.path("silver", TOUCHED))
    return {"dates": touched, "rows": counts}
