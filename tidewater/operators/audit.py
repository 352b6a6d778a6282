"""V4 from mergeable summaries: the session audit without a window over events.

What the audit needs to know of a run of a session's events, whatever came
before it, is a transition summary: its first event and first and last
watch_seconds, whether a terminal event is in it, and the counts that break a
rule inside it, for either state in which the run can be entered (a terminal
event seen or not, a pause open or not). Two summaries of neighbouring runs
merge into the summary of both, so

- events are range-partitioned on (session, time, tie) and read once in order;
  a hot session is cut wherever the ranges cut it, with no checkpoint and no
  carry joined back to its rows: each task gives one summary for each session
  and day it saw a part of;
- a day's summaries are a table, and a new day adds its own; the audit of any
  days merges a few rows for each session (``merged``, ``audit``).

The attribute changes need the distinct values, kept as (session, day,
attribute, value) rows, which merge by ``distinct``.

Order and results are those of ``quality.session_audit``: NULL times first, ties
by the message's place, a NULL watch_seconds compares with nothing, an unknown
event type is neither a pause nor a terminal event, NULL sessions are one
session.
"""

from __future__ import annotations

from typing import Dict, Iterator, Optional, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schema import TERMINAL_EVENT_TYPES
from ..session import ship_package
from .quality import SESSION_ATTRIBUTES

#: One run of a session's events on one day. ``after``: events behind a terminal event of the run;
#: ``falls``: decreases of watch_seconds inside it; ``bad``: resumes without a pause, none being open before.
SUMMARY = (
    "session_id string, event_date date, first_at timestamp, first_tie {tie}, events long, first_type string, first_watch int, last_watch int, "
    "terminal boolean, after long, falls long, bad long, first_pr string, last_pr string"
)
_COLUMNS = [c.split()[0] for c in SUMMARY.split(", ")]


def _merge(a: dict, b: dict) -> dict:
    """Summary of two neighbouring runs."""
    fall = a["last_watch"] is not None and b["first_watch"] is not None and a["last_watch"] > b["first_watch"]
    closed = a["last_pr"] == "pause" and b["first_pr"] == "resume"
    return {
        **a,
        "events": a["events"] + b["events"],
        "last_watch": b["last_watch"],
        "terminal": a["terminal"] or b["terminal"],
        "after": a["after"] + (b["events"] if a["terminal"] else b["after"]),
        "falls": a["falls"] + b["falls"] + fall,
        "bad": a["bad"] + b["bad"] - closed,
        "first_pr": a["first_pr"] or b["first_pr"],
        "last_pr": b["last_pr"] or a["last_pr"],
    }


def _summaries(b: pa.RecordBatch) -> Dict[str, list]:
    """Columns of the runs' summaries of a batch in order of session, time and tie."""
    n = b.num_rows
    code = lambda c: pc.fill_null(b.column(c).dictionary_encode().indices, -1).to_numpy(zero_copy_only=False)
    session, day = code("session_id"), code("event_date")
    new = np.ones(n, bool)
    new[1:] = (session[1:] != session[:-1]) | (day[1:] != day[:-1])
    start = np.flatnonzero(new)
    run = np.cumsum(new) - 1
    total = lambda x: np.add.reduceat(x.astype(np.int64), start).tolist()

    watch = b.column("watch_seconds")
    value, known = pc.fill_null(watch, 0).to_numpy(zero_copy_only=False), watch.is_valid().to_numpy(zero_copy_only=False)
    falls = np.zeros(n, bool)
    falls[1:] = ~new[1:] & known[1:] & known[:-1] & (value[:-1] > value[1:])

    kind = b.column("event_type")
    is_in = lambda *v: pc.is_in(kind, pa.array(v, kind.type)).to_numpy(zero_copy_only=False)
    terminal = is_in(*TERMINAL_EVENT_TYPES)
    seen = np.cumsum(terminal)
    behind = seen - terminal - (seen - terminal)[start][run] > 0

    at = np.flatnonzero(is_in("pause", "resume"))
    pause = is_in("pause")[at]
    opens = np.ones(len(at), bool)  # the first of its run
    opens[1:] = run[at[1:]] != run[at[:-1]]
    bad = np.zeros(n, bool)
    bad[at] = ~pause & (opens | ~np.append(False, pause[:-1]))
    name = np.where(pause, "pause", "resume")
    first_pr, last_pr = [None] * len(start), [None] * len(start)
    closes = np.append(opens[1:], True) if len(at) else opens
    for i in np.flatnonzero(opens):
        first_pr[run[at[i]]] = str(name[i])
    for i in np.flatnonzero(closes):
        last_pr[run[at[i]]] = str(name[i])

    first, last = pa.array(start), pa.array(np.append(start[1:], n) - 1)
    pick = lambda c, i: b.column(c).take(i).to_pylist()
    return {
        "session_id": pick("session_id", first), "event_date": pick("event_date", first), "first_at": pick("event_timestamp", first),
        "first_tie": pick("tie", first), "events": np.diff(np.append(start, n)).tolist(), "first_type": pick("event_type", first),
        "first_watch": pick("watch_seconds", first), "last_watch": pick("watch_seconds", last),
        "terminal": [x > 0 for x in total(terminal)], "after": total(behind), "falls": total(falls), "bad": total(bad),
        "first_pr": first_pr, "last_pr": last_pr,
    }


def session_summaries(df: DataFrame, tie: Optional[str] = None) -> DataFrame:
    """Transition summaries of every session and event_date, one for each task that saw a part."""
    if tie is None:
        tie = "kafka_offset" if "kafka_offset" in df.columns else "event_id"
    ship_package(df.sparkSession)
    kind = df.schema[tie].dataType.simpleString()
    schema = SUMMARY.format(tie=kind)

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Optional[dict] = None  # the last run may go on in the next batch
        types = None
        for b in batches:
            if not b.num_rows:
                continue
            types = types or pa.schema([
                ("session_id", pa.string()), ("event_date", pa.date32()), ("first_at", b.schema.field("event_timestamp").type), ("first_tie", b.schema.field("tie").type),
                ("events", pa.int64()), ("first_type", pa.string()), ("first_watch", pa.int32()), ("last_watch", pa.int32()), ("terminal", pa.bool_()),
                ("after", pa.int64()), ("falls", pa.int64()), ("bad", pa.int64()), ("first_pr", pa.string()), ("last_pr", pa.string()),
            ])
            columns = _summaries(b)
            row = lambda i: {c: columns[c][i] for c in _COLUMNS}
            if held is not None:
                if (held["session_id"], held["event_date"]) == (columns["session_id"][0], columns["event_date"][0]):
                    for c, v in _merge(held, row(0)).items():
                        columns[c][0] = v
                else:
                    for c in _COLUMNS:
                        columns[c].insert(0, held[c])
            held = row(-1)
            if len(columns["events"]) > 1:
                yield pa.RecordBatch.from_pydict({c: columns[c][:-1] for c in _COLUMNS}, schema=types)
        if held is not None:
            yield pa.RecordBatch.from_pydict({c: [held[c]] for c in _COLUMNS}, schema=types)

    events = df.select("session_id", F.to_date("event_timestamp").alias("event_date"), "event_timestamp", F.col(tie).alias("tie"), "event_type", "watch_seconds")
    keys = ["session_id", "event_timestamp", "tie"]
    return events.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(summarise, schema)


def session_values(df: DataFrame, attributes: Sequence[str] = SESSION_ATTRIBUTES) -> DataFrame:
    """(session_id, event_date, attribute, value): the distinct values of each session and day."""
    # Tuples first: they collapse in the map tasks, and only these few rows are unpivoted.
    few = df.select("session_id", F.to_date("event_timestamp").alias("event_date"), *attributes).distinct()
    pairs = F.explode(F.array(*[F.struct(F.lit(a).alias("attribute"), F.col(a).cast("string").alias("value")) for a in attributes]))
    return few.select("session_id", "event_date", pairs.alias("p")).select("session_id", "event_date", "p.*").filter("value IS NOT NULL").distinct()


def merged(summaries: DataFrame, keys: Sequence[str] = ("session_id", "event_date")) -> DataFrame:
    """The summaries of neighbouring runs merged to one for each of ``keys``; merging merged ones is the same."""
    order = [F.asc_nulls_first("first_at"), F.asc_nulls_first("first_tie")]
    w = Window.partitionBy(*keys).orderBy(*order)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    known = summaries.select(
        "*",
        F.row_number().over(w).alias("_no"),
        F.coalesce(F.max("terminal").over(before), F.lit(False)).alias("_ended"),
        F.lag("last_watch").over(w).alias("_watch"),
        F.last("last_pr", ignorenulls=True).over(before).alias("_pr"),
    )
    yes = lambda c: F.coalesce(c, F.lit(False)).cast("long")
    first = lambda c: F.min_by(c, "_no").alias(c)
    rest = [c for c in ("session_id", "event_date") if c not in keys]
    return known.groupBy(*keys).agg(
        *[first(c) for c in (*rest, "first_at", "first_tie")],
        F.sum("events").alias("events"),
        first("first_type"),
        first("first_watch"),
        F.max_by("last_watch", "_no").alias("last_watch"),
        F.max("terminal").alias("terminal"),
        F.sum(F.when(F.col("_ended"), F.col("events")).otherwise(F.col("after"))).alias("after"),
        F.sum(F.col("falls") + yes(F.col("_watch") > F.col("first_watch"))).alias("falls"),
        F.sum(F.col("bad") - yes((F.col("_pr") == "pause") & (F.col("first_pr") == "resume"))).alias("bad"),
        F.min_by("first_pr", F.when(F.col("first_pr").isNotNull(), F.col("_no"))).alias("first_pr"),
        F.max_by("last_pr", F.when(F.col("last_pr").isNotNull(), F.col("_no"))).alias("last_pr"),
    ).select(*_COLUMNS)


def audit(summaries: DataFrame, values: DataFrame) -> DataFrame:
    """V4's rows from the summaries and values of any days."""
    one = merged(summaries, ("session_id",)).withColumn("_s", F.struct("session_id"))
    distinct = values.groupBy("session_id", "attribute").agg(F.count_distinct("value").alias("n"))
    changes = distinct.groupBy("session_id").agg(F.sum(F.col("n") - 1).alias("changes")).withColumn("_s", F.struct("session_id")).drop("session_id")
    return one.join(changes, "_s", "left").select(
        "session_id",
        "events",
        F.coalesce(F.col("first_type") == "play", F.lit(False)).alias("starts_with_play"),
        F.col("bad").alias("resume_without_pause"),
        F.col("after").alias("events_after_terminal"),
        F.col("falls").alias("watch_decreases"),
        F.coalesce("changes", F.lit(0)).cast("long").alias("attribute_changes"),
    )

