"""Operator 11, filter interaction audit: Lehmer-rank difference arrays.

Every document has a mask of the filters it fails. How often a filter removes,
or finds removed already, in all orders of the filters follows from the masks'
counts alone: the orders whose first s filters are a given prefix lie next to
each other in lexicographic (Lehmer) order, so a mask's removal at step s covers
whole intervals of ranks. The counts are added at the intervals' ends, and one
prefix sum over the ranks gives every order's totals.

Plan: one pass over the texts leaves (id, part, digest, four bits) in the shared
folder; the smallest id of each digest is a partial aggregate; rows are
collapsed by (digest, id) before the two joins, and rows without an id are dealt
by their digest, so no copied text, repeated row or null id gathers in one task.
What follows works on (part, mask) counts: 32 rows a part.

Bounds: the intervals are a table of at most (filters x 2^filters x orders)
rows, a constant of the filters (about 5,000 for five); it is broadcast.

Defined cases: a null text counts as empty, a null part is the empty string; a
null id is never smaller nor larger than an id, so its row fails no duplicate
check and causes none; rows that repeat an id with the same text are not
duplicates of each other and all count; of several labels of an id the largest
counts, a missing one as 0; other columns are ignored; an empty table gives no
parts and so no rows.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial
from typing import List, Tuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ASCII_SPACE, saved

FILTERS = "ABCDE"
#: Limits of the contract's filters: words, percent of distinct words, percent of capitals, symbols.
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS, SYMBOLS = 50, 65, 5, "[#$%&*|]"


def intervals(filters: str = FILTERS) -> List[Tuple[int, int, bool, int, int]]:
    """(mask, step, first, lo, hi): the ranks lo..hi-1 of all orders in which a document
    with this mask fails the filter at this step, for the first time or (not first) again."""
    out: List[Tuple[int, int, bool, int, int]] = []
    for mask in range(1, 1 << len(filters)):
        for step in range(1, len(filters) + 1):
            width = factorial(len(filters) - step)  # orders that share a prefix of this length
            open_: dict = {}
            for i, prefix in enumerate(permutations(range(len(filters)), step)):
                if not mask >> prefix[-1] & 1:
                    continue
                first = not any(mask >> f & 1 for f in prefix[:-1])
                lo, hi = open_.get(first, (None, None))
                if hi == i * width:
                    open_[first] = (lo, hi + width)
                else:
                    if hi is not None:
                        out.append((mask, step, first, lo, hi))
                    open_[first] = (i * width, (i + 1) * width)
            out += [(mask, step, first, lo, hi) for first, (lo, hi) in open_.items()]
    return out


def failures(docs: DataFrame, labels: DataFrame, part_col: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(part, mask, docs, good, toxic): rows by the set of filters they fail; bit i is filter i of FILTERS."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    rows = rows.withColumn("w", F.array_remove(F.split("text", ASCII_SPACE), ""))
    bits = [
        F.size("w") < MIN_WORDS,
        100 * F.size(F.array_distinct("w")) < MIN_DISTINCT * F.size("w"),
        100 * F.regexp_count("text", F.lit("[A-Z]")).cast("long") > MAX_CAPITALS * F.length("text").cast("long"),
        F.col("text").rlike(SYMBOLS),
    ]
    own = sum((b.cast("int") * (1 << i) for i, b in enumerate(bits)), F.lit(0))
    base = saved(rows.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), own.alias("own")), "failures")

    firsts = base.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).filter("doc_id IS NOT NULL").withColumn("first", F.lit(True))
    rows = base.groupBy("digest", "doc_id", "part", "own").agg(F.count(F.lit(1)).alias("n")).join(firsts, ["digest", "doc_id"], "left")
    rows = rows.select("doc_id", "part", "n", F.col("own") + F.when(F.col("doc_id").isNotNull() & F.col("first").isNull(), 16).otherwise(0).cast("int"), F.coalesce("doc_id", F.xxhash64("digest")))
    rows = rows.toDF("doc_id", "part", "n", "mask", "dealt")
    known = labels.groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("bad")
    )
    rows = rows.join(known, (F.col("dealt") == F.col("label_id")) & F.col("doc_id").isNotNull(), "left")
    count = lambda c: F.sum(F.col("n") * F.coalesce(F.col(c), F.lit(0)))
    return rows.groupBy("part", "mask").agg(F.sum("n").alias("docs"), count("good").alias("good"), count("bad").alias("toxic"))


def audit(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step, from (part, mask, docs, good, toxic)."""
    spark = counts.sparkSession
    steps, orders = len(filters), factorial(len(filters))
    counts = saved(counts, "masks")
    spans = spark.createDataFrame(intervals(filters), "mask int, step int, first boolean, lo int, hi int")
    ends = counts.join(F.broadcast(spans), "mask").select(
        "part", "step", "first", "docs", "good", "toxic",
        F.explode(F.array(F.struct(F.col("lo").alias("rank"), F.lit(1).alias("sign")), F.struct(F.col("hi").alias("rank"), F.lit(-1).alias("sign")))).alias("end"),
    )
    add = lambda c, first: F.sum(F.when(F.col("first") == first, F.col(c) * F.col("end.sign")).otherwise(0))
    ends = ends.groupBy("part", "step", F.col("end.rank").alias("rank")).agg(
        add("docs", True).alias("removed"), add("docs", False).alias("redundant"), add("good", True).alias("good_lost"), add("toxic", True).alias("toxic_lost")
    )
    sums = ("removed", "redundant", "good_lost", "toxic_lost")

    alone = [F.coalesce(F.sum(F.when(F.col("mask") == 1 << i, F.col("docs"))), F.lit(0)) for i in range(steps)]
    parts = counts.groupBy("part").agg(F.sum("docs").alias("total"), F.array(*alone).alias("alone"))
    grid = parts.select("part", "total", "alone", F.explode(F.sequence(F.lit(0), F.lit(orders - 1))).alias("rank"))
    grid = grid.select("*", F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("step"))
    names = spark.createDataFrame(list(enumerate("".join(p) for p in permutations(filters))), "rank int, filter_order string")
    grid = grid.join(F.broadcast(names), "rank").join(ends, ["part", "step", "rank"], "left")

    along = Window.partitionBy("part", "step").orderBy("rank")
    grid = grid.select("part", "total", "alone", "rank", "step", "filter_order", *(F.sum(F.coalesce(c, F.lit(0))).over(along).alias(c) for c in sums))
    letter = F.substring("filter_order", F.col("step"), F.lit(1))
    return grid.select(
        "part",
        "filter_order",
        "step",
        (F.col("total") - F.sum("removed").over(Window.partitionBy("part", "rank").orderBy("step"))).alias("kept"),
        "removed",
        "redundant",
        F.element_at("alone", F.instr(F.lit(filters), letter)).alias("unique_fails"),
        "good_lost",
        "toxic_lost",
        F.sum("removed").over(Window.partitionBy("part", letter)).alias("shapley"),
    )


def filter_audit(docs: DataFrame, labels: DataFrame, part_col: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The audit of the five filters over ``docs``, by ``part_col``."""
    return audit(failures(docs, labels, part_col, id_col, text_col))
