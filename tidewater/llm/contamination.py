"""Operator 5, benchmark decontamination: size-partitioned MinHash containment
search, in DataFrame functions only.

An item is contained in a document when at least ``threshold`` of its distinct
shingles of five words occur there (white-space words, A-Z lower-cased; an item
of fewer words is one shorter shingle, looked up as such).

1. The documents' shingles are reduced to those that any item has: containment
   is the same in the reduced sets, and their sizes are comparable with the
   items'. Shingles are made and looked up row by row behind an explode inside
   one code-generated stage; the look-up compares 64-bit hashes, then words.
2. Documents with the same reduced set (a passage that thousands of documents
   quote) share one entry from here on.
3. Sets and items are partitioned by size (powers of two). For a pair of size
   classes, containment t implies a least Jaccard similarity, and that the
   number of MinHash values after which a contained item is missed with
   probability ``miss`` only. Equal (number, value) rows are the candidates.
   Where more values would be needed than MAX_VALUES (a very large set against
   small items), every shared shingle makes a candidate instead: exact.
4. Candidates are verified by the exact intersection of shingle sets.

The items' distinct shingles are broadcast when there are at most
``broadcast_rows`` of them (about 100 bytes each), else joined by shuffle: then
the documents' shingles travel as (id, place, hash), and the words behind equal
hashes are compared where the document lies.

Defined cases: null and empty texts contain nothing, null and empty items are
contained in nothing; rows that repeat an id are one document (or item); rows
with a null id have no name to report and give no pair; other columns are
ignored; empty tables give an empty result.
"""

from __future__ import annotations

import math
from functools import reduce
from typing import List

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ASCII_SPACE, ascii_lower, saved, texts

WORDS = 5
MAX_VALUES = 256


def words(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(text), ASCII_SPACE), lambda w: w != "")


def _key(w: Column, at: Column, size: int) -> Column:
    return F.xxhash64(*[F.get(w, at + k) for k in range(size)])


def shingles(named: DataFrame, size: int) -> DataFrame:
    """(id, w, at, key) for every run of ``size`` words; ``named`` has (id, w)."""
    runs = named.filter(F.size("w") >= size)
    runs = runs.select("id", "w", F.explode(F.sequence(F.lit(0), F.size("w") - size)).alias("at"))
    return runs.withColumn("key", _key(F.col("w"), F.col("at"), size))


def item_shingles(items: DataFrame) -> DataFrame:
    """Saved (item_id, size, key, shingle): the distinct shingles of every item."""
    named = items.select(F.col("doc_id").alias("id"), words(F.col("text")).alias("w")).filter("id IS NOT NULL")
    parts = []
    for size in range(1, WORDS + 1):
        own = named.filter(F.size("w") >= WORDS if size == WORDS else F.size("w") == size)
        text = F.concat_ws(" ", F.slice("w", F.col("at") + 1, size))
        parts.append(shingles(own, size).select(F.col("id").alias("item_id"), F.lit(size).alias("size"), "key", text.alias("shingle")))
    return saved(reduce(DataFrame.unionByName, parts).distinct(), "items")


def values_needed(threshold: float, set_class: int, item_class: int, miss: float) -> int:
    """MinHash values after which a contained item of 2^item_class shingles or more is
    missed in a set of fewer than 2^(set_class + 1) with probability ``miss``; 0: can't contain it."""
    most, least = (2 << set_class) - 1, 1 << item_class
    if most < threshold * least:
        return 0
    j = threshold * least / (most + least - threshold * least)
    return 1 if j >= 1 else math.ceil(math.log(miss) / math.log1p(-min(j, 1 - 1e-12)))


def _size_class(size: Column) -> Column:
    return F.floor(F.log2(size.cast("double")) + 1e-9).cast("int")


def _minhash(members: Column, number: Column) -> Column:
    """Values 0..number-1, each the smallest seeded hash over the members."""
    return F.transform(F.sequence(F.lit(0), number - 1), lambda i: F.array_min(F.transform(members, lambda s: F.xxhash64(s, i))))


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    threshold: float = 0.8,
    miss: float = 1e-6,
    broadcast_rows: int = 500_000,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """doc_id, item_id, shared, item_shingles, containment: one row per contained item."""
    spark = docs.sparkSession
    known = item_shingles(texts(items, item_col, item_text_col))
    universe = saved(known.groupBy("size", "shingle").agg(F.min("key").alias("key")).withColumn("sid", F.monotonically_increasing_id()), "universe")
    item_sets = known.join(universe.select("size", "shingle", "sid"), ["size", "shingle"]).groupBy("item_id").agg(F.array_sort(F.collect_set("sid")).alias("iset"))
    item_sets = saved(item_sets.withColumn("k", _size_class(F.size("iset"))), "item-sets")

    # 1. Documents reduced to the items' shingles.
    named = texts(docs, id_col, text_col).filter("doc_id IS NOT NULL").select(F.col("doc_id").alias("id"), words(F.col("text")).alias("w"))
    small = universe.count() <= broadcast_rows
    hits = []
    for (size,) in sorted(universe.select("size").distinct().collect()):
        wanted = universe.filter(F.col("size") == size).select("key", "shingle", "sid")
        own = F.concat_ws(" ", F.slice("w", F.col("at") + 1, size))
        if small:
            found = shingles(named, size).join(F.broadcast(wanted), "key").filter(own == F.col("shingle"))
        else:
            # Only hashes are shuffled; the words of what met are compared in a second join.
            met = shingles(named, size).select("id", "at", "key").join(wanted, "key").drop("key")
            met = met.groupBy("id").agg(F.collect_list(F.struct("at", "shingle", "sid")).alias("met"))
            found = named.join(met, "id").select("id", "w", F.explode("met").alias("m")).select("id", "w", "m.*").filter(own == F.col("shingle"))
        hits.append(found.select("id", "sid"))
    schema = "doc_id long, item_id long, shared long, item_shingles long, containment double"
    if not hits:
        return spark.createDataFrame([], schema)
    reduced = reduce(DataFrame.unionByName, hits).groupBy("id").agg(F.array_sort(F.collect_set("sid")).alias("set"))
    reduced = saved(reduced, "reduced")

    # 2. Distinct sets.
    sets = saved(reduced.select("set").distinct().select(F.monotonically_increasing_id().alias("set_id"), "set", _size_class(F.size("set")).alias("c")), "sets")

    # 3. Candidates by pairs of size classes (at most about 40 x 40 values reach the driver).
    item_classes: List[int] = [r.k for r in item_sets.select("k").distinct().collect()]
    set_classes: List[int] = [r.c for r in sets.select("c").distinct().collect()]
    needed = {(c, k): values_needed(threshold, c, k, miss) for c in set_classes for k in item_classes}
    pairs = [(c, k, b) for (c, k), b in needed.items() if 0 < b <= MAX_VALUES]
    exact = [(c, k) for (c, k), b in needed.items() if b > MAX_VALUES]
    candidates = spark.createDataFrame([], "set_id long, item_id long")
    if pairs:
        plan = spark.createDataFrame(pairs, "c int, k int, b int")
        of_set = plan.groupBy("c").agg(F.max("b").alias("number"))
        of_item = plan.groupBy("k").agg(F.max("b").alias("number"))
        left = sets.join(F.broadcast(of_set), "c").select("set_id", "c", F.posexplode(_minhash(F.col("set"), F.col("number"))).alias("i", "value"))
        right = item_sets.join(F.broadcast(of_item), "k").select("item_id", "k", F.posexplode(_minhash(F.col("iset"), F.col("number"))).alias("i", "value"))
        met = left.join(right, ["i", "value"]).join(F.broadcast(plan), ["c", "k"]).filter("i < b")
        candidates = candidates.unionByName(met.select("set_id", "item_id"))
    if exact:
        plan = spark.createDataFrame(exact, "c int, k int")
        left = sets.join(F.broadcast(plan.select("c").distinct()), "c").select("set_id", "c", F.explode("set").alias("sid"))
        right = item_sets.select("item_id", "k", F.explode("iset").alias("sid"))
        candidates = candidates.unionByName(left.join(right, "sid").join(F.broadcast(plan), ["c", "k"]).select("set_id", "item_id"))

    # 4. Exact containment, then back to the documents.
    both = candidates.distinct().join(sets.select("set_id", "set"), "set_id").join(item_sets.select("item_id", "iset"), "item_id")
    both = both.select("set", "item_id", F.size(F.array_intersect("set", "iset")).cast("long").alias("shared"), F.size("iset").cast("long").alias("item_shingles"))
    both = both.withColumn("containment", F.col("shared") / F.col("item_shingles")).filter(F.col("containment") >= threshold)
    return reduced.join(saved(both, "contained"), "set").select(F.col("id").alias("doc_id"), "item_id", "shared", "item_shingles", "containment")


def drop_contaminated(docs: DataFrame, items: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose text contains an item.

    Texts stand for themselves here (by their 64-bit hash), so null and repeated
    ids are judged like others, and copies once.
    """
    own = docs.withColumn("_hash", F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    leaks = contained_items(own, items, threshold, id_col="_hash", text_col=text_col)
    return own.join(leaks.select(F.col("doc_id").alias("_hash")).distinct(), "_hash", "left_anti").select(*docs.columns)
