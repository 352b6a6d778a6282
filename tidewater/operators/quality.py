"""Filters, dedupe and data quality: F1-F3, V1-V5.

All checks are native column expressions and aggregates (no UDF). Skew rule:
no operator sends a whole key to one task; dedupe and per-session checks are
aggregates with map-side partial aggregation, and ordered checks go through the
skew-safe ordered scan of ``functions.windows``.
"""

from __future__ import annotations

from typing import Optional, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.windows import DEFAULT_HOT_ROWS, DEFAULT_SLICE_ROWS, ordered_scan
from ..schema import (
    ENUM_RULES,
    EVENT_COLUMNS,
    LENGTH_RULES,
    RANGE_RULES,
    REQUIRED_FIELDS,
    TERMINAL_EVENT_TYPES,
)

# ---------------------------------------------------------------------------
# F1-F3
# ---------------------------------------------------------------------------


def drop_unparsed(df: DataFrame) -> DataFrame:
    """keep rows whose event_id parsed (S1). Runs before the dedupe
    shuffle, so unparsable rows never pile up in one NULL-key task."""
    return df.filter(F.col("event_id").isNotNull())


def dedupe_events(df: DataFrame, key: str = "event_id", order: Sequence[str] = ("kafka_partition", "kafka_offset"),
                  fast: bool = False) -> DataFrame:
    """one row per event_id; the survivor is the lowest (partition, offset).

    Written as an aggregate, ``min_by(row, (partition, offset))``: partial
    aggregation collapses a burst of retries map-side, so a key copied a
    billion times costs one row per map task in the shuffle, where a
    ``row_number`` window would ship every copy to one task. Deterministic,
    unlike the reference's ``dropDuplicates`` (S3). ``fast=True`` is
    ``dropDuplicates`` (arbitrary survivor) for callers that do not care.
    """
    if fast:
        return df.dropDuplicates([key])
    rest = [c for c in df.columns if c != key]
    order_cols = [c for c in order if c in df.columns]
    if not order_cols:
        order_cols = rest
    ordering = F.struct(*[F.col(c) for c in order_cols])
    kept = df.groupBy(key).agg(F.min_by(F.struct(*[F.col(c) for c in rest]), ordering).alias("_r"))
    return kept.select(*[F.col(key) if c == key else F.col(f"_r.{c}").alias(c) for c in df.columns])


def silver_report(bronze: DataFrame) -> DataFrame:
    """bronze_rows, unparsed_rows, duplicate_rows, silver_rows, dropped_rows.

    One aggregate over Bronze: the distinct count gives the Silver size
    without writing it. (The pipeline itself counts via ``observe`` on its
    write, see ``plans.jobs``.)
    """
    agg = bronze.agg(
        F.count(F.lit(1)).alias("bronze_rows"),
        F.count_if(F.col("event_id").isNull()).alias("unparsed_rows"),
        F.count_distinct("event_id").alias("silver_rows"),
    )
    return agg.select(
        "bronze_rows",
        "unparsed_rows",
        (F.col("bronze_rows") - F.col("unparsed_rows") - F.col("silver_rows")).alias("duplicate_rows"),
        "silver_rows",
        (F.col("bronze_rows") - F.col("silver_rows")).alias("dropped_rows"),
    )


# ---------------------------------------------------------------------------
# V1-V3: contract validation
# ---------------------------------------------------------------------------


def contract_rules(exclude: Sequence[str] = ()) -> list:
    """The section 1.2 contract as (rule name, violated-condition) pairs.

    A NULL value raises only ``<field>_missing``; length, enum and range rules
    test present values only.
    """
    rules = []
    for f in REQUIRED_FIELDS:
        rules.append((f"{f}_missing", F.col(f).isNull()))
    for f, (lo, hi) in LENGTH_RULES.items():
        n = F.length(F.col(f))
        rules.append((f"{f}_length", F.col(f).isNotNull() & ((n < lo) | (n > hi))))
    for f, (name, values) in ENUM_RULES.items():
        rules.append((name, F.col(f).isNotNull() & ~F.col(f).isin(list(values))))
    for f, (name, lo, hi) in RANGE_RULES.items():
        rules.append((name, F.col(f).isNotNull() & ((F.col(f) < lo) | (F.col(f) > hi))))
    return [(n, c) for n, c in rules if n not in set(exclude)]


def rule_names(rules: Optional[list] = None) -> list:
    return [n for n, _ in (rules if rules is not None else contract_rules())]


def violations_column(rules: Optional[list] = None) -> Column:
    rules = rules if rules is not None else contract_rules()
    tagged = F.array(*[F.when(cond, F.lit(name)) for name, cond in rules])
    return F.array_sort(F.filter(tagged, lambda x: x.isNotNull()))


def validate_events(df: DataFrame, rules: Optional[list] = None) -> DataFrame:
    """V1: all input rows plus ``violations`` (sorted array of rule names)."""
    return df.withColumn("violations", violations_column(rules))


NAIVE_RULE = "event_timestamp_naive"
# A time of day followed by Z or an offset, or a bare number (epoch seconds).
_ZONED = r"(?i)(:\d{2}(\.\d+)?\s*(Z|[+-]\d{2}(:?\d{2})?)|^-?\d+(\.\d+)?)$"


def validate_wire(wire: DataFrame, rules: Optional[list] = None) -> DataFrame:
    """V1 on wire records: the Bronze columns plus ``violations``, with the rule
    that only the text can show: a timestamp without a zone. The parse reads
    such a text as UTC, so the rule comes before it. A missing or unreadable
    timestamp raises ``event_timestamp_missing`` instead."""
    from .wire import flatten_event, kafka_metadata, parse_json

    text = F.get_json_object(F.col("value").cast("string"), "$.event_timestamp")
    bronze = flatten_event(wire.select(*kafka_metadata(), parse_json(F.col("value")).alias("event"), text.alias("_text")))
    naive = F.col("event_timestamp").isNotNull() & ~F.trim("_text").rlike(_ZONED)
    checked = validate_events(bronze, rules)
    more = F.when(naive, F.array(F.lit(NAIVE_RULE))).otherwise(F.array().cast("array<string>"))
    return checked.withColumn("violations", F.array_sort(F.concat("violations", more))).drop("_text")


def quarantine_status(df: DataFrame, rules: Optional[list] = None) -> DataFrame:
    """V2 as one frame: V1's output plus ``status`` = 'valid' | 'rejected'.

    One narrow pass; a writer partitions the result by ``status``
    (``sinks.tables.write_quarantine``), so both sides are written by the same
    job and readers select one side by partition pruning.
    """
    return validate_events(df, rules).withColumn(
        "status", F.when(F.size("violations") == 0, F.lit("valid")).otherwise(F.lit("rejected"))
    )


def quarantine_split(df: DataFrame, rules: Optional[list] = None):
    """V2: (valid, rejected). Valid keeps the input columns; rejected adds
    ``violations``. Both are filters of one validated frame (no shuffle); to
    materialise both, write ``quarantine_status`` once instead of running two
    actions over the input."""
    checked = quarantine_status(df, rules)
    valid = checked.filter(F.col("status") == "valid").drop("violations", "status")
    rejected = checked.filter(F.col("status") == "rejected").drop("status")
    return valid, rejected


def violation_counts(df: DataFrame, rules: Optional[list] = None) -> DataFrame:
    """V3: rows per violated rule (a row counts under each rule it breaks).

    One count for each rule, then a row for each count above 0. Exploding the rows'
    ``violations`` would have Spark infer a filter on their number and push it to
    the source, where every field that a rule names parses the message anew.
    """
    rules = rules if rules is not None else contract_rules()
    counts = df.agg(*[F.count_if(cond).alias(f"_{i}") for i, (_, cond) in enumerate(rules)])
    named = F.array(*[F.struct(F.lit(name).alias("violation"), F.col(f"_{i}").alias("rows")) for i, (name, _) in enumerate(rules)])
    return counts.select(F.inline(named)).filter("rows > 0").groupBy("violation").agg(F.sum("rows").alias("rows"))


# ---------------------------------------------------------------------------
# V4: session state-machine audit
# ---------------------------------------------------------------------------

SESSION_ATTRIBUTES = ("user_id", "content_id", "content_type", "device_type", "app_version", "country_code")


def session_audit(
    df: DataFrame,
    tie: Optional[str] = None,
    attributes: Sequence[str] = SESSION_ATTRIBUTES,
    hot_rows: int = DEFAULT_HOT_ROWS,
    slice_rows: int = DEFAULT_SLICE_ROWS,
) -> DataFrame:
    """V4: invariants of the session state machine, one row per session.

    Order: event_timestamp, then ``tie`` (kafka_offset when present, else
    event_id). Output: session_id, events, starts_with_play,
    resume_without_pause, events_after_terminal, watch_decreases,
    attribute_changes.

    Plan: one ``ordered_scan`` (skew-safe: a hot session, one with more
    than ``hot_rows`` rows, is cut into balanced slices) gives per row the
    previous watch_seconds, the number of terminal events so far and the
    last pause/resume before it; one aggregate per session (partial, so a hot
    session collapses map-side) counts the rows that break a rule. No join
    back to the events.
    """
    if tie is None:
        tie = "kafka_offset" if "kafka_offset" in df.columns else "event_id"
    ts = "event_timestamp"
    terminal = F.col("event_type").isin(list(TERMINAL_EVENT_TYPES))
    ev = df.select(
        *dict.fromkeys(["session_id", ts, tie, "event_type", "watch_seconds", *attributes]),
        F.coalesce(terminal, F.lit(False)).cast("long").alias("_term"),
        F.when(F.col("event_type").isin("pause", "resume"), F.col("event_type")).alias("_pr"),
    )
    scanned = ordered_scan(
        ev, ["session_id"], ts, tie,
        lag=["watch_seconds"], running_sum=["_term"], last_before=["_pr"],
        prefix="_s_", hot_rows=hot_rows, slice_rows=slice_rows,
    )
    after_terminal = (F.col("_s_cum__term") - F.col("_term")) > 0
    bad_resume = (F.col("event_type") == "resume") & F.coalesce(F.col("_s_last__pr") != "pause", F.lit(True))
    watch_falls = F.col("_s_prev_watch_seconds") > F.col("watch_seconds")
    # First per (session, attributes), partial in the window's own tasks, so the
    # distinct counts expand these few rows and not the events.
    counts = scanned.groupBy("session_id", *attributes).agg(
        F.count(F.lit(1)).alias("events"),
        # The first row of a session is the one without a predecessor: a
        # boolean aggregate, so the whole aggregate stays hash-based.
        F.bool_or(~F.col("_s_has_prev") & (F.col("event_type") == "play")).alias("_starts_play"),
        F.count_if(bad_resume).alias("resume_without_pause"),
        F.count_if(after_terminal).alias("events_after_terminal"),
        F.count_if(F.coalesce(watch_falls, F.lit(False))).alias("watch_decreases"),
    )
    per_session = counts.groupBy("session_id").agg(
        F.bool_or("_starts_play").alias("_starts_play"),
        *[F.sum(c).alias(c) for c in ("events", "resume_without_pause", "events_after_terminal", "watch_decreases")],
        *[F.count_distinct(a).alias(f"_nd_{a}") for a in attributes],
    )
    changes = sum((F.greatest(F.col(f"_nd_{a}") - 1, F.lit(0)) for a in attributes), F.lit(0))
    return per_session.select(
        "session_id",
        "events",
        F.coalesce(F.col("_starts_play"), F.lit(False)).alias("starts_with_play"),
        F.col("resume_without_pause").cast("long").alias("resume_without_pause"),
        F.col("events_after_terminal").cast("long").alias("events_after_terminal"),
        F.col("watch_decreases").cast("long").alias("watch_decreases"),
        changes.cast("long").alias("attribute_changes"),
    )


# ---------------------------------------------------------------------------
# V5: ingest metrics per Kafka partition
# ---------------------------------------------------------------------------


def ingest_metrics(wire: DataFrame, schema=None) -> DataFrame:
    """V5: messages, bytes, parsed, failed, offsets per Kafka partition.

    Runs on the wire table (``value`` still present). ``failed`` = event_id
    NULL after the parse (P2). One aggregate, partial per partition.
    """
    from .wire import parse_json

    ev = parse_json(F.col("value")) if schema is None else parse_json(F.col("value"), schema)
    failed = ev.getField("event_id").isNull()
    return wire.groupBy(F.col("partition").alias("kafka_partition")).agg(
        F.count(F.lit(1)).alias("messages"),
        F.sum(F.octet_length("value")).cast("long").alias("bytes"),
        F.count_if(~failed).alias("parsed"),
        F.count_if(failed).alias("failed"),
        F.min("offset").alias("min_offset"),
        F.max("offset").alias("max_offset"),
    )


__all__ = [
    "drop_unparsed",
    "dedupe_events",
    "silver_report",
    "contract_rules",
    "validate_events",
    "validate_wire",
    "quarantine_split",
    "quarantine_status",
    "violation_counts",
    "session_audit",
    "ingest_metrics",
    "EVENT_COLUMNS",
]
