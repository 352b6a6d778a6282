"""F5 through a trigram index: session search that reads postings, not all sessions.

Every distinct user and session id is folded (letter case beyond ASCII included,
as in the case-insensitive match of ``search_sessions``) and cut into its runs of
three characters. The postings (field, gram, value) are partitioned by a hash of
the gram and sorted by it, so a search reads the partitions of its own grams and,
inside them, the row groups that hold them. Values that have all grams of the
pattern's literal parts are candidates; the exact regular expression decides, and
the sessions of the values found are fetched by two joins.

A pattern whose literal parts have no three characters in a row (alternatives at
the top, classes, short texts) can't use the index and scans, with the same rows.
"""

from __future__ import annotations

import re
from typing import List

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import contains_ci
from .serving import search_sessions

FIELDS = ("user_id", "session_id")
#: Partitions of the postings; a search of g grams reads g of them at most.
BUCKETS = 64
GRAM = 3


def folded(text: Column) -> Column:
    """One form for all characters that match each other without regard to case.

    Character by character: the dotted capital I, which alone lower-cases to two
    characters, is taken as i, and the final sigma as the plain one.
    """
    # The optimiser drops the inner one of two case functions that follow each other, and both
    # are needed (long s, sharp s): the sigmas are mapped in between.
    low = F.translate(F.lower(F.translate(text, "İ", "i")), "ς", "σ")
    high = F.translate(F.upper(low), "ς", "Σ")
    return F.translate(F.lower(high), "ς", "σ")


def grams(text: Column) -> Column:
    """The distinct runs of three characters of a folded text."""
    starts = F.sequence(F.lit(1), F.greatest(F.length(text) - GRAM + 1, F.lit(1)))
    return F.when(F.length(text) >= GRAM, F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, F.lit(GRAM))))).otherwise(F.array().cast("array<string>"))


def _bucket(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(BUCKETS)).cast("int")


def postings(sessions: DataFrame) -> DataFrame:
    """(field, gram, value, bucket) of every distinct id of the session table."""
    out = None
    for field in FIELDS:
        values = sessions.select(F.lit(field).alias("field"), F.col(field).alias("value")).filter("value IS NOT NULL").distinct()
        out = values if out is None else out.unionByName(values)
    found = out.withColumn("f", folded(F.col("value"))).select("field", "value", F.explode(grams(F.col("f"))).alias("gram"))
    return found.select("field", "gram", "value", _bucket(F.col("gram")).alias("bucket"))


def write_postings(sessions: DataFrame, path: str) -> None:
    """The index as a table: partitioned by bucket, in each file sorted by gram."""
    rows = postings(sessions).repartitionByRange("bucket", "gram", "value").sortWithinPartitions("bucket", "gram", "value")
    rows.write.partitionBy("bucket").parquet(path)


def literal_parts(pattern: str) -> List[str]:
    """Runs of characters that every match of ``pattern`` holds, as far as plainly seen.

    Only characters outside groups and classes count, a quantified one only under
    ``+``; where alternatives or anything unusual stand at the top, there are none.
    """
    parts, run, i, n = [], "", 0, len(pattern)

    def end() -> None:
        nonlocal run
        parts.append(run)
        run = ""

    while i < n:
        c = pattern[i]
        if c == "|" or c in ")]}" or pattern.startswith("(?", i) or pattern.startswith("\\Q", i):
            return []
        if c in "([":
            close, depth, j, in_class = ")" if c == "(" else "]", 0, i, False
            while j < n:
                d = pattern[j]
                if d == "\\":
                    j += 1
                elif d == "[":
                    in_class, depth = True, depth + (c == "[")
                elif d == "]" and in_class:
                    in_class, depth = False, depth - (c == "[")
                elif c == "(" and not in_class and d in "()":
                    if pattern.startswith("(?", j):
                        return []
                    depth += 1 if d == "(" else -1
                if depth == 0 and d == close:
                    break
                j += 1
            else:
                return []
            end()
            i = j + 1
        elif c in ".^$":
            end()
            i += 1
        elif c == "\\":
            if i + 1 >= n:
                return []
            if pattern[i + 1].isalnum():
                end()
            else:
                run += pattern[i + 1]
            i += 2
        else:
            run += c
            i += 1
        # What a quantifier leaves of the last character.
        q = re.match(r"[*?]|\{\d*,?\d*\}|\+", pattern[i:])
        if q:
            if q.group() != "+":
                run = run[:-1]
            end()
            i += q.end()
            if pattern[i : i + 1] in ("?", "+"):
                i += 1
    end()
    return [p for p in parts if len(p) >= GRAM]


def search_sessions_indexed(sessions: DataFrame, index: DataFrame, search: str = "", literal: bool = False) -> DataFrame:
    """F5 with ``index``, the table of ``write_postings``; the rows of ``search_sessions``."""
    parts = [search] if literal and len(search) >= GRAM else ([] if literal else literal_parts(search))
    if not parts:
        return search_sessions(sessions, search, literal)
    spark = sessions.sparkSession
    # The pattern's grams and their buckets: a few literals, so that they prune partitions.
    texts = spark.createDataFrame([(p,) for p in parts], "part string")
    wanted = [tuple(r) for r in texts.select(F.explode(grams(folded(F.col("part")))).alias("g")).distinct().select("g", _bucket(F.col("g"))).collect()]
    if not wanted:
        return search_sessions(sessions, search, literal)
    hits = index.filter(F.col("bucket").isin(sorted({b for _, b in wanted})) & F.col("gram").isin([g for g, _ in wanted]))
    candidates = hits.groupBy("field", "value").agg(F.count_distinct("gram").alias("n")).filter(F.col("n") == len(wanted))
    found = candidates.filter(contains_ci("value", search, literal))
    out = sessions
    for field in FIELDS:
        values = found.filter(F.col("field") == field).select(F.col("value").alias(field), F.lit(True).alias(f"_{field}"))
        out = out.join(values, field, "left")
    return out.filter(F.coalesce(*[F.col(f"_{f}") for f in FIELDS], F.lit(False))).select(*sessions.columns)
