"""Exact distinct counts as bitmaps that merge over days.

A distinct count can't be added up over days. A bitmap can be OR-ed: every user
and session gets a dense number, a group's members of a bucket of 32,768 numbers
are the bits of one 4 KB value, and the distinct count is the number of bits.
All of it is Spark's ``bitmap_*`` functions: one partial aggregate per map task,
no list of members, and no ``Expand``, which the usual plan of two distinct
counts needs.

``daily_states`` has one row per (day, group, kind, bucket); ``merged`` ORs the
states of any set of days into the group's counts. Numbers are given in order of
arrival, so the members of a day lie in few buckets; a bitmap with few bits is
mostly zeros, which Parquet and the shuffle's compression shrink.

NULL members aren't counted, NULL keys are groups of their own, and a sum over
NULLs only stays NULL, as in the aggregates these replace.
"""

from __future__ import annotations

from typing import Optional, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

NUMBERS = "id string, n long"
#: What is counted, by the column of the rollup that names it.
MEMBERS = {"user": "user_id", "session": "session_id"}


def new_numbers(ids: DataFrame, known: Optional[DataFrame], path: str, column: str) -> DataFrame:
    """(id, n): dense numbers for the values of ``column`` that ``known`` doesn't have yet.

    Numbers go on where ``known`` ends. The new values are written to ``path`` in
    their task's order first, which pins that order; one row per task (its
    count) gives the tasks their first numbers.
    """
    spark = ids.sparkSession
    fresh = ids.select(F.col(column).alias("id")).filter("id IS NOT NULL").distinct()
    start = F.lit(0)
    if known is not None:
        fresh = fresh.join(known, "id", "left_anti")
        start = F.coalesce(known.agg(F.max("n")).scalar() + 1, F.lit(0))
    at = F.monotonically_increasing_id()  # task number and row number within the task
    fresh.select("id", F.shiftright(at, 33).alias("task"), at.bitwiseAND(F.lit((1 << 33) - 1)).alias("row")).write.parquet(path)
    placed = spark.read.schema("id string, task long, row long").parquet(path)
    sizes = placed.groupBy("task").agg(F.count(F.lit(1)).alias("size"))
    before = F.sum("size").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    bases = sizes.select("task", F.coalesce(before, F.lit(0)).alias("base"))
    return placed.join(bases, "task").select("id", (start + F.col("base") + F.col("row")).cast("long").alias("n"))


def daily_states(rollup: DataFrame, numbers: dict, keys: Sequence[str]) -> DataFrame:
    """(event_date, keys, kind, bucket, bits, watch, events) of a session-day rollup.

    ``numbers`` has an (id, n) table per kind of MEMBERS. Kind ``sums`` carries
    the additive measures in one row per (day, group).
    """
    group = ["event_date", *[k for k in keys if k != "event_date"]]
    sums = rollup.groupBy(*group).agg(F.sum("r_watch").cast("long").alias("watch"), F.sum("r_events").cast("long").alias("events"))
    none = lambda t: F.lit(None).cast(t)
    out = sums.select(*group, F.lit("sums").alias("kind"), F.lit(0).cast("long").alias("bucket"), none("binary").alias("bits"), "watch", "events")
    for kind, column in MEMBERS.items():
        # A pair is numbered once, however many rows of the rollup it has.
        pairs = rollup.filter(F.col(column).isNotNull()).select(*group, F.col(column).alias("id")).distinct()
        bits = pairs.join(numbers[kind], "id").groupBy(*group, F.bitmap_bucket_number("n").alias("bucket"))
        bits = bits.agg(F.bitmap_construct_agg(F.bitmap_bit_position("n")).alias("bits"))
        out = out.unionByName(bits.select(*group, F.lit(kind).alias("kind"), "bucket", "bits", none("long").alias("watch"), none("long").alias("events")))
    return out


def merged(states: DataFrame, keys: Sequence[str], users_as: str = "unique_users") -> DataFrame:
    """(keys, total_watch_seconds, ``users_as``, unique_sessions, event_count) over all days in ``states``."""
    by_bucket = states.groupBy(*keys, "kind", "bucket").agg(
        F.bitmap_count(F.bitmap_or_agg("bits")).alias("members"), F.sum("watch").alias("watch"), F.sum("events").alias("events")
    )
    count = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("members"))), F.lit(0))
    return by_bucket.groupBy(*keys).agg(
        F.sum("watch").cast("long").alias("total_watch_seconds"),
        count("user").alias(users_as),
        count("session").alias("unique_sessions"),
        F.sum("events").cast("long").alias("event_count"),
    )
