"""Ordered per-key computations that stay correct and parallel on hot keys.

A window ``partitionBy(key)`` sends every row of a key to one task. When one
key (a bot user, a replayed session) holds a third of all rows, that task is
the job. ``ordered_scan`` therefore cuts *hot* keys into slices, runs the
window per (key, slice), and carries state across slices through a small
per-slice table. Ordinary keys have a plain window and no carry; both are united
at the end.

Hot keys are the heavy hitters: keys with more than
``max(hot_rows, total_rows / max_hot_keys)`` rows. Their number is below
``max_hot_keys`` by construction (their rows add up to at most the total), so
the hot-key table has a proven size bound and is broadcast explicitly. The
largest window partition of an ordinary key is at most that threshold.

The rows of hot keys are range-partitioned on (key, ts, tie): the range
partitioner samples the data and cuts it into contiguous, balanced slices of
about ``slice_rows`` rows, whatever the distribution of timestamps (a burst or
one replayed timestamp included, as ``tie`` breaks equal times). The slice id
(the partition id) is monotone in (ts, tie) within a key. A reliable
checkpoint (under ``spark.checkpoint.dir``) pins the slices, because a second
sampling run could cut elsewhere and the rows and the carry must agree.

Plan shape:

- key counts: partial aggregate per key (one narrow row per key and map
  task), the total from the same counts as a scalar subquery; the number of
  hot rows is the only value that reaches the driver;
- no hot key: a plain window per key, nothing else;
- hot keys: broadcast join with the hot-key table (narrow), hot rows
  range-sliced and checkpointed; Exchange(key, slice) and one Window operator
  for all frames; carry from a partial aggregate per (key, slice) of the
  checkpoint and a window over the slices of each key; left join on (key,
  slice) of the hot rows alone, then the union with the ordinary rows.

Keys are packed into one non-null struct column and NULL timestamps sort
first, so NULL keys or timestamps are never filtered by the joins.
``hot_rows=0`` slices every key (tests).

With a hot key the input is read several times (key counts for the number of
hot rows and again for the broadcast, the range sampler, the slice shuffle,
the ordinary rows):
pass a table scan (column pruning keeps the extra reads narrow) or a
checkpointed frame, not an expensive derivation.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# Keys with more rows than this (or than total / DEFAULT_MAX_HOT_KEYS, when
# larger) are cut into slices of about DEFAULT_SLICE_ROWS rows.
DEFAULT_HOT_ROWS = 1_000_000
DEFAULT_MAX_HOT_KEYS = 1_000_000
DEFAULT_SLICE_ROWS = 1_000_000

_K = "_tw_key"
_B = "_tw_slice"
_HOT = "_tw_hot"


def hot_keys(keyed: DataFrame, key: str, hot_rows: int, max_hot_keys: int) -> DataFrame:
    """Keys (column ``key``) with more than max(hot_rows, total / max_hot_keys)
    rows, with their row count ``_tw_n`` and the flag ``_tw_hot``. Fewer than
    ``max_hot_keys`` rows by construction."""
    counts = keyed.groupBy(key).agg(F.count(F.lit(1)).alias("_tw_n"))
    total = counts.select(F.sum("_tw_n")).scalar()
    threshold = F.greatest(F.lit(int(hot_rows)).cast("double"), total.cast("double") / F.lit(float(max_hot_keys)))
    return counts.filter(F.col("_tw_n") > threshold).select(key, "_tw_n", F.lit(True).alias(_HOT))


def _plain_scan(keyed, keys, ts, tie, lag, running_sum, last_before, prefix) -> DataFrame:
    """No hot key: the same columns from one window per key. Partitioned by the
    key columns themselves, so that an aggregate on them needs no second shuffle."""
    w = Window.partitionBy(*keys).orderBy(F.col(ts).asc_nulls_first(), F.col(tie).asc_nulls_first())
    out = {f"{prefix}has_prev": F.row_number().over(w) > 1}
    for c in lag:
        out[f"{prefix}prev_{c}"] = F.lag(c).over(w)
    for c in running_sum:
        out[f"{prefix}cum_{c}"] = F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    for c in last_before:
        out[f"{prefix}last_{c}"] = F.last(c, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return keyed.withColumns(out).drop(_K)


def ordered_scan(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    tie: str,
    lag: Sequence[str] = (),
    running_sum: Sequence[str] = (),
    last_before: Sequence[str] = (),
    prefix: str = "",
    hot_rows: int = DEFAULT_HOT_ROWS,
    max_hot_keys: int = DEFAULT_MAX_HOT_KEYS,
    slice_rows: int = DEFAULT_SLICE_ROWS,
) -> DataFrame:
    """Per row, in (ts, tie) order within ``keys`` (NULLs first), adds:

    - ``{prefix}has_prev``: the row has a predecessor in its key;
    - ``{prefix}prev_<c>``: value of ``c`` on the previous row (``lag``);
    - ``{prefix}cum_<c>``: running SUM of ``c`` up to and including the row;
    - ``{prefix}last_<c>``: last non-NULL ``c`` strictly before the row.

    Equal to the same window functions over ``partitionBy(keys)`` when
    (ts, tie) is unique within a key, without the one-task-per-key limit.
    """
    keyed = df.withColumn(_K, F.struct(*[F.col(k) for k in keys]))
    if hot_rows and hot_rows > 0:
        hot = hot_keys(keyed, _K, hot_rows, max_hot_keys)
        n_hot = hot.agg(F.sum("_tw_n")).first()[0] or 0
        if n_hot == 0:
            return _plain_scan(keyed, keys, ts, tie, lag, running_sum, last_before, prefix)
        tagged = keyed.join(F.broadcast(hot.select(_K, _HOT)), on=_K, how="left")
        ordinary = tagged.filter(F.col(_HOT).isNull()).drop(_HOT)
        hot_part = tagged.filter(F.col(_HOT).isNotNull())
    else:
        ordinary, hot_part = None, keyed.withColumn(_HOT, F.lit(True))
        n_hot = keyed.count()
    # Contiguous, balanced slices of each hot key's (ts, tie) order, pinned.
    ensure_checkpoint_dir(keyed.sparkSession)
    n_slices = max(1, math.ceil(n_hot / max(1, int(slice_rows))))
    split = (
        hot_part.repartitionByRange(n_slices, F.col(_K), F.col(ts).asc_nulls_first(), F.col(tie).asc_nulls_first())
        .withColumn(_B, F.spark_partition_id().cast("long"))
        .checkpoint(eager=True)
    )
    # In-slice frames.
    w = Window.partitionBy(_K, _B).orderBy(F.col(ts).asc_nulls_first(), F.col(tie).asc_nulls_first())
    w_run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    w_before = w.rowsBetween(Window.unboundedPreceding, -1)
    cols = {"_tw_first": F.row_number().over(w) == 1}
    for c in lag:
        cols[f"_tw_lag_{c}"] = F.lag(c).over(w)
    for c in running_sum:
        cols[f"_tw_run_{c}"] = F.sum(c).over(w_run)
    for c in last_before:
        cols[f"_tw_lb_{c}"] = F.last(c, ignorenulls=True).over(w_before)
    rows = split.withColumns(cols)

    # One summary row per (key, slice) of the hot keys: last row, total, last
    # non-NULL value. Struct order is (ts, tie) with NULLs first, as in the
    # window above.
    order = F.struct(F.col(ts), F.col(tie))
    aggs = [F.count(F.lit(1)).alias("_tw_n")]
    aggs += [F.max_by(F.col(c), order).alias(f"_tw_blast_{c}") for c in lag]
    aggs += [F.sum(c).alias(f"_tw_btot_{c}") for c in running_sum]
    aggs += [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(f"_tw_bln_{c}") for c in last_before]
    slices = split.groupBy(_K, _B).agg(*aggs)
    # Carried into each slice from the earlier slices of the same key.
    wk = Window.partitionBy(_K).orderBy(_B)
    wk_before = wk.rowsBetween(Window.unboundedPreceding, -1)
    carry_cols = [F.lag(_B).over(wk).isNotNull().alias("_tw_cprev")]
    carry_cols += [F.lag(f"_tw_blast_{c}").over(wk).alias(f"_tw_clag_{c}") for c in lag]
    carry_cols += [F.sum(f"_tw_btot_{c}").over(wk_before).alias(f"_tw_csum_{c}") for c in running_sum]
    carry_cols += [F.last(f"_tw_bln_{c}", ignorenulls=True).over(wk_before).alias(f"_tw_clast_{c}")
                   for c in last_before]
    carry = slices.select(_K, _B, *carry_cols)

    # The plain window's type: the sum of partial sums would widen a decimal.
    plain = keyed.agg(*[F.sum(c).alias(c) for c in running_sum]).schema if running_sum else None
    j = rows.join(carry, on=[_K, _B], how="left")
    first = F.col("_tw_first")
    out = {f"{prefix}has_prev": ~first | F.coalesce(F.col("_tw_cprev"), F.lit(False))}
    for c in lag:
        out[f"{prefix}prev_{c}"] = F.when(first, F.col(f"_tw_clag_{c}")).otherwise(F.col(f"_tw_lag_{c}"))
    for c in running_sum:
        off, cur = F.col(f"_tw_csum_{c}"), F.col(f"_tw_run_{c}")
        # SUM semantics: NULL only while every value so far is NULL.
        out[f"{prefix}cum_{c}"] = F.when(off.isNull() & cur.isNull(), F.lit(None)).otherwise(
            F.coalesce(off, F.lit(0)) + F.coalesce(cur, F.lit(0))
        ).cast(plain[c].dataType)
    for c in last_before:
        out[f"{prefix}last_{c}"] = F.coalesce(F.col(f"_tw_lb_{c}"), F.col(f"_tw_clast_{c}"))
    internal = [c for c in j.columns if c.startswith("_tw_")]
    sliced = j.withColumns(out).drop(*internal)
    if ordinary is None:
        return sliced
    # Rows of ordinary keys need no carry: one window for each key, united with the hot ones here.
    return _plain_scan(ordinary, keys, ts, tie, lag, running_sum, last_before, prefix).unionByName(sliced)


def cumulative_sum(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    tie: str,
    value: str,
    out: str,
    hot_rows: int = DEFAULT_HOT_ROWS,
    slice_rows: int = DEFAULT_SLICE_ROWS,
) -> DataFrame:
    """``sum(value) over (partition by keys order by ts, tie)`` as ``out``."""
    scanned = ordered_scan(df, keys, ts, tie, running_sum=[value], prefix="_cs_", hot_rows=hot_rows,
                           slice_rows=slice_rows)
    return scanned.withColumnRenamed(f"_cs_cum_{value}", out).drop("_cs_has_prev")


def previous_row(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    tie: str,
    cols: Sequence[str],
    out: str = "prev",
    hot_rows: int = DEFAULT_HOT_ROWS,
    slice_rows: int = DEFAULT_SLICE_ROWS,
) -> DataFrame:
    """``lag(struct(cols))`` over ``partitionBy(keys).orderBy(ts, tie)`` as ``out``."""
    scanned = ordered_scan(df, keys, ts, tie, lag=cols, prefix="_pr_", hot_rows=hot_rows, slice_rows=slice_rows)
    prev = F.struct(*[F.col(f"_pr_prev_{c}").alias(c) for c in cols])
    return scanned.withColumn(out, F.when(F.col("_pr_has_prev"), prev)).drop(
        "_pr_has_prev", *[f"_pr_prev_{c}" for c in cols]
    )
