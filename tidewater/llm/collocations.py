"""Operator 13, phrase collocation mining: multikey three-way quicksort of suffix pointers.

Every word position is a suffix of at most ``depth`` words that ends with its
piece. Suffixes are routed by their leading two words, so all suffixes that
share a longer beginning lie in one bin; there a multikey three-way quicksort
orders pointers to them, word by word: the size of each equal partition is the
count of a phrase, and partitions below the least count are abandoned.

Plan: one pass counts words and summarises frequent leading words; a second
one collapses equal suffixes of each slice of text to one with a weight, cuts
them by bin and ships each cut as one compressed block (local vocabulary plus
integer columns). Bins hold about BIN suffixes, so their number grows with the
corpus. What is left, the phrases with the least count or more, is scored and
filtered by joins on (lang, phrase).

Skew: a Misra-Gries summary finds leading pairs and triples that may hold more
than a bin's worth of suffixes. Such a pair is routed by three words, such a
triple by all four. Their own counts then come in parts, which are summed and
never abandoned; the longer ones under them are complete in their bins. Equal
suffixes of four words collapse in the map tasks.

Bounds: the frequent beginnings are at most 2 x (HEAVY + 1) hashes (a quarter
of a megabyte), taken along in the tasks' closure; a pair or triple beyond
them holds at most 2 x tokens / HEAVY suffixes. A summary reaches the driver
summed over the partitions, never by partition.

Defined cases: a null text counts as empty, a null language as ``und``; ids
aren't read, repeated rows all count; texts of any length are cut into words as
a whole; other columns are ignored; ties are broken by count and then by the
phrase's bytes; an empty table gives no rows.
"""

from __future__ import annotations

from typing import Dict, Iterator, List, Sequence, Tuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WorkerCache, saved, slices

DEPTH = 4
#: Suffixes of a bin, and hashes of frequent beginnings at most.
BIN, HEAVY = 1_000_000, 16_384
#: Bytes of text that a map task turns into suffixes at a time.
SLICE = 6 << 20
#: Partitions of the quicksort below this many pointers are finished together by one sort.
SMALL = 1_024

#: Class of each byte: 0 in a word, 1 between words, 2 between pieces.
CLASS = np.zeros(256, np.uint8)
CLASS[[0x20, 0x09]] = 1
CLASS[list(b".,;:!?\n\x0b\x0c\r")] = 2
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def pieces(text: pa.Array) -> Tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """(code, row, piece) of each word of lower-cased texts, and the distinct words.

    Pieces are numbered over all rows; words of one row and piece follow each other.
    """
    text = pc.fill_null(text.cast(pa.large_binary()), b"")
    ends = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
    data = text.buffers()[2]
    flat = LOWER[np.frombuffer(data, np.uint8)[ends[0] : ends[-1]]] if data else np.zeros(0, np.uint8)
    ends = ends - ends[0]
    kind = CLASS[flat]
    inside = kind == 0
    starts_row = np.zeros(len(flat) + 1, bool)
    starts_row[ends] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | starts_row[1:-1]
    at = np.flatnonzero(first)
    row = np.searchsorted(ends, at, "right") - 1
    breaks = np.cumsum(kind == 2, dtype=np.int64)
    piece = breaks[at] + row
    # Word bytes without what separates them, cut where words start.
    offsets = np.append(np.cumsum(inside, dtype=np.int64)[at] - 1, inside.sum())
    body = flat[inside]
    words = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(body)])
    coded = words.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), row, piece, coded.dictionary


def suffixes(code: np.ndarray, row: np.ndarray, piece: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """depth x words: codes of the words that follow within the piece, -1 beyond its end."""
    out = np.full((depth, len(code)), -1, np.int64)
    out[0] = code
    for j in range(1, min(depth, len(code))):
        same = piece[j:] == piece[:-j]
        out[j, :-j] = np.where(same, code[j:], -1)
    return out


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def prefix_hashes(columns: np.ndarray, lang_hash: np.ndarray, word_hash: np.ndarray) -> List[np.ndarray]:
    """Hash of the first 1, 2, .. words of each suffix (with its language); used only for routing."""
    out, h = [], lang_hash
    hashes = np.append(word_hash, np.uint64(0))  # -1 takes the last
    for c in columns:
        h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + hashes[c])
        out.append(h)
    return out


def collapse(columns: np.ndarray, lang: np.ndarray, vocabulary: int) -> Tuple[np.ndarray, np.ndarray]:
    """(one pointer for each distinct suffix, how often it occurs), in order of language and words."""
    v = vocabulary + 1
    order = np.lexsort(((columns[2] + 1) * v + columns[3] + 1, (lang * v + columns[0] + 1) * v + columns[1] + 1))
    if not len(order):
        return order, order
    new = np.zeros(len(order), bool)
    new[0] = True
    for c in (lang, *columns):
        s = c[order]
        new[1:] |= s[1:] != s[:-1]
    starts = np.flatnonzero(new)
    return order[starts], np.diff(np.append(starts, len(order)))


def multikey_quicksort(columns: Sequence[np.ndarray], weight: np.ndarray, least: Sequence[int], small: int = SMALL) -> Iterator[Tuple[np.ndarray, int, np.ndarray]]:
    """(pointer to an example, words, count) of every beginning with at least ``least[words-1]``.

    ``columns`` are the suffixes' keys (the first also tells languages apart),
    -1 where a suffix has ended. Pointers are parted in three by a pivot; the
    equal part goes on with the next word. Parts that can't hold a count that
    is asked for are abandoned.
    """
    asked = [min(least[d:]) for d in range(len(least))]
    stack: List[Tuple[np.ndarray, int]] = [(np.arange(len(weight)), 0)]
    rest: List[np.ndarray] = []
    depths: List[int] = []
    found: Dict[int, List[Tuple[int, int]]] = {d: [] for d in range(1, len(columns) + 1)}
    while stack:
        pointers, depth = stack.pop()
        if weight[pointers].sum() < asked[depth]:
            continue
        if len(pointers) <= small:
            rest.append(pointers)
            depths.append(depth)
            continue
        keys = columns[depth][pointers]
        some = np.sort(keys[:: max(1, len(keys) // 64)])
        pivot = some[len(some) // 2]
        for side in (keys < pivot, keys > pivot):
            if side.any():
                stack.append((pointers[side], depth))
        equal = pointers[keys == pivot]
        if pivot == -1:
            continue  # these suffixes end here
        count = int(weight[equal].sum())
        if count >= least[depth]:
            found[depth + 1].append((int(equal[0]), count))
        if depth + 1 < len(columns):
            stack.append((equal, depth + 1))
    for d, hits in found.items():
        if hits:
            yield np.array([h[0] for h in hits]), d, np.array([h[1] for h in hits])
    if not rest:
        return
    # Small parts, all together: one sort, then runs of equal beginnings.
    pointers, depth = np.concatenate(rest), np.repeat(depths, [len(r) for r in rest])
    order = np.lexsort(tuple(c[pointers] for c in columns[::-1]))
    pointers, depth = pointers[order], depth[order]
    new = np.zeros(len(pointers), bool)
    new[0] = True
    for d, c in enumerate(columns):
        keys = c[pointers]
        new[1:] |= keys[1:] != keys[:-1]
        starts = np.flatnonzero(new)
        counts = np.add.reduceat(weight[pointers], starts)
        hit = (counts >= least[d]) & (depth[starts] <= d) & (keys[starts] >= 0)
        yield pointers[starts[hit]], d + 1, counts[hit]


def _languages(b: pa.RecordBatch) -> Tuple[np.ndarray, List[str], np.ndarray]:
    coded = b.column("lang").dictionary_encode()
    names = coded.dictionary.to_pylist()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), names, np.array([xxhash.xxh64_intdigest(x) for x in names], np.uint64)


def _hashes(words: pa.Array, cache: WorkerCache) -> np.ndarray:
    cache.trim()
    return np.array([cache[w] for w in words.to_pylist()], np.uint64)


def survey(docs: DataFrame, heavy: int) -> DataFrame:
    """Saved (kind, lang, word, hash, n): the words of each slice with their counts (kind 0), and
    the Misra-Gries summary of each partition's leading pairs (2) and triples (3)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WorkerCache(xxhash.xxh64_intdigest)
        often = {2: (np.zeros(0, np.uint64), np.zeros(0, np.int64)), 3: (np.zeros(0, np.uint64), np.zeros(0, np.int64))}
        for b in slices(batches, size=SLICE):
            lang, names, lang_hash = _languages(b)
            code, row, piece, words = pieces(b.column("text"))
            if not len(code):
                continue
            lang = lang[row]
            seen, n = np.unique(lang * len(words) + code, return_counts=True)
            which, word = np.divmod(seen, len(words))
            yield _rows(0, pa.array(names).take(pa.array(which)), words.take(pa.array(word)).cast(pa.large_string()).cast(pa.string()), None, n)
            columns = suffixes(code, row, piece, 3)
            hashes = prefix_hashes(columns, lang_hash[lang], _hashes(words, cache))
            for d in (2, 3):
                key, n = np.unique(hashes[d - 1][columns[d - 1] >= 0], return_counts=True)
                often[d] = _misra_gries(*often[d], key, n, heavy)
        for d, (key, n) in often.items():
            yield _rows(d, None, None, key.view(np.int64), n)

    return saved(docs.mapInArrow(count, "kind int, lang string, word string, hash long, n long"), "survey")


def _rows(kind: int, lang, word, key, n: np.ndarray) -> pa.RecordBatch:
    none = lambda t: pa.nulls(len(n), t)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(n), kind, np.int32)),
            none(pa.string()) if lang is None else lang,
            none(pa.string()) if word is None else word,
            none(pa.int64()) if key is None else pa.array(key),
            pa.array(n.astype(np.int64)),
        ],
        ["kind", "lang", "word", "hash", "n"],
    )


def _misra_gries(keys: np.ndarray, counts: np.ndarray, more: np.ndarray, n: np.ndarray, k: int) -> Tuple[np.ndarray, np.ndarray]:
    """The merged summary: at most ``k`` keys, each count short by at most total/(k+1)."""
    merged, at = np.unique(np.concatenate([keys, more]), return_inverse=True)
    total = np.bincount(at, np.concatenate([counts, n]).astype(np.float64), len(merged)).astype(np.int64)
    if len(merged) <= k:
        return merged, total
    cut = np.partition(total, len(total) - k - 1)[len(total) - k - 1]
    keep = total > cut
    return merged[keep], total[keep] - cut


def heavy_prefixes(seen: DataFrame, tokens: int, bins: int, heavy: int) -> Dict[int, np.ndarray]:
    """Sorted hashes of the leading pairs (2) and triples (3) that may hold more than a bin's worth."""
    # An estimate is short by at most tokens/(heavy+1); at most heavy+1 sums reach that share.
    share = max(tokens / bins / 2 - tokens / (heavy + 1), tokens / (heavy + 1), 2)
    rows = seen.filter("kind > 0").groupBy("kind", "hash").agg(F.sum("n").alias("n")).filter(F.col("n") >= F.lit(float(share))).select("kind", "hash").collect()
    return {d: np.sort(np.array([r[1] for r in rows if r[0] == d], np.int64).view(np.uint64)) for d in (2, 3)}


def _in(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return known[at] == values


def routed(docs: DataFrame, bins: int, heavy: Dict[int, np.ndarray]) -> DataFrame:
    """(bin, block): weighted suffixes of each slice by bin, compressed.

    ``split`` tells how many leading words a suffix was routed by.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WorkerCache(xxhash.xxh64_intdigest)
        for b in slices(batches, size=SLICE):
            lang, names, lang_hash = _languages(b)
            code, row, piece, words = pieces(b.column("text"))
            if not len(code):
                continue
            lang = lang[row]
            columns = suffixes(code, row, piece)
            pointers, weight = collapse(columns, lang, len(words))
            keep = columns[1][pointers] >= 0  # a lone word starts no phrase
            pointers, weight = pointers[keep], weight[keep]
            columns, lang = columns[:, pointers], lang[pointers]
            hashes = prefix_hashes(columns, lang_hash[lang], _hashes(words, cache))
            split = np.full(len(pointers), 2, np.int64)
            split[_in(hashes[1], heavy[2])] = 3
            split[(split == 3) & _in(hashes[2], heavy[3])] = 4
            to = (np.choose(split - 2, hashes[1:]) % np.uint64(bins)).astype(np.int64)
            order = np.argsort(to, kind="stable")
            edges = np.searchsorted(to[order], np.arange(bins + 1))
            for i in np.flatnonzero(np.diff(edges)):
                part = order[edges[i] : edges[i + 1]]
                yield pa.RecordBatch.from_pydict(
                    {"bin": pa.array([i], pa.int32()), "block": pa.array([_pack(columns[:, part], lang[part], split[part], weight[part], words, names)], pa.binary())}
                )

    return docs.mapInArrow(cut, "bin int, block binary")


def _pack(columns: np.ndarray, lang: np.ndarray, split: np.ndarray, weight: np.ndarray, words: pa.Array, names: List[str]) -> bytes:
    used, at = np.unique(columns, return_inverse=True)
    local = at.reshape(columns.shape).astype(np.int64)
    if used[0] == -1:
        used = used[1:]
        local -= 1
    batch = pa.RecordBatch.from_pydict({"w" + str(j): pa.array(c.astype(np.int32)) for j, c in enumerate(local)} | {
        "lang": pa.DictionaryArray.from_arrays(pa.array(lang.astype(np.int32)), pa.array(names, pa.string())),
        "split": pa.array(split.astype(np.int8)),
        "weight": pa.array(weight.astype(np.int64)),
    })
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    with pa.ipc.new_stream(sink, batch.schema, options=options) as w:
        w.write_batch(batch)
    with pa.ipc.new_stream(sink, pa.schema([("word", pa.large_binary())]), options=options) as w:
        w.write_batch(pa.RecordBatch.from_arrays([words.take(pa.array(used))], ["word"]))
    return sink.getvalue().to_pybytes()


def _unpack(block: pa.Scalar) -> Tuple[pa.RecordBatch, pa.Array]:
    source = pa.BufferReader(block.as_buffer())
    (batch,) = pa.ipc.open_stream(source)
    (words,) = pa.ipc.open_stream(source)
    return batch, words.column(0)


def phrase_counts(blocks: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, words, f): counts of phrases of 2 to DEPTH words by bin, complete where
    the suffixes were routed by no more words than the phrase has."""

    def mine(group: pa.Table) -> pa.Table:
        parts = [_unpack(x) for chunk in group.column("block").chunks for x in chunk]
        distinct = pa.chunked_array([w for _, w in parts]).combine_chunks().dictionary_encode()
        codes, words = distinct.indices.to_numpy(zero_copy_only=False).astype(np.int64), distinct.dictionary
        names = sorted({x for b, _ in parts for x in b.column("lang").dictionary.to_pylist()})
        columns, lang, split, weight, base = [], [], [], [], 0
        for b, w in parts:
            own = np.append(codes[base : base + len(w)], -1)
            base += len(w)
            columns.append(np.stack([own[b.column(f"w{j}").to_numpy()] for j in range(DEPTH)]).astype(np.int32))
            known = np.array([names.index(x) for x in b.column("lang").dictionary.to_pylist()], np.int64)
            lang.append(known[b.column("lang").indices.to_numpy()])
            split.append(b.column("split").to_numpy())
            weight.append(b.column("weight").to_numpy())
        parts.clear()
        keys, lang, split, weight = np.concatenate(columns, axis=1), np.concatenate(lang), np.concatenate(split), np.concatenate(weight)
        columns.clear()
        out: List[pa.Table] = []
        for by in (2, 3, 4):
            own = np.flatnonzero(split == by)
            if not len(own):
                continue
            sort_by = [lang[own] * len(words) + keys[0][own], *(k[own] for k in keys[1:])]
            # Beginnings shorter than the routing are parts of a count: all of them are kept.
            asked = [least if d >= by or by == 2 else 1 for d in range(1, DEPTH + 1)]
            for pointers, length, counts in multikey_quicksort(sort_by, weight[own], asked):
                if length < 2 or not len(pointers):
                    continue
                at = own[pointers]
                phrase = pc.binary_join_element_wise(*(words.take(pa.array(keys[j][at])) for j in range(length)), pa.scalar(b" ", pa.large_binary()))
                out.append(pa.table({
                    "lang": pa.array(names).take(pa.array(lang[at])), "phrase": phrase.cast(pa.large_string()).cast(pa.string()),
                    "words": pa.array(np.full(len(at), length, np.int32)), "f": pa.array(counts.astype(np.int64)),
                }))
        return pa.concat_tables(out) if out else SHAPE.empty_table()

    return blocks.groupBy("bin").applyInArrow(mine, "lang string, phrase string, words int, f long")


SHAPE = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("words", pa.int32()), ("f", pa.int64())])


def scored(counts: DataFrame, totals: DataFrame, top: int) -> DataFrame:
    """The best candidates by language, from (lang, phrase, words, f) of all frequent phrases and words."""
    whole = lambda c: F.col(c).cast("decimal(20,0)")
    found = counts.filter("words > 1").withColumn("w", F.split("phrase", " ", -1))
    slice_of = lambda start, n: F.array_join(F.slice("w", start, n), " ")

    inner = found.filter("words > 2").select("lang", "f", "words", "w", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("n"))
    inner = inner.select("lang", "f", "w", "n", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("n") + 1)).alias("start"))
    inner = inner.groupBy("lang", slice_of(F.col("start"), F.col("n")).alias("phrase")).agg(F.max("f").alias("longer"))
    kept = found.join(inner, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (100 * whole("longer") < 80 * whole("f")))

    cuts = kept.select("lang", "phrase", "words", F.col("f").alias("a"), "w", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", slice_of(F.lit(1), F.col("k")).alias("head"), slice_of(F.col("k") + 1, F.col("words") - F.col("k")).alias("tail"))
    heads = counts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = counts.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    cuts = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"])
    score = F.expr("(CAST(2000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(20,0))) div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))")
    best = cuts.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    best = best.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def collocations(
    docs: DataFrame, least: int = 30, top: int = 2_000, lang_col: str = "lang", text_col: str = "text", bin_size: int = BIN, heavy: int = HEAVY
) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    docs = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    seen = survey(docs, heavy)
    words = saved(seen.filter("kind = 0").groupBy("lang", "word").agg(F.sum("n").alias("f")), "words")
    totals = saved(words.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    tokens = totals.agg(F.sum("n")).first()[0] or 0
    bins = max(1, -(-tokens // bin_size))
    found = phrase_counts(routed(docs, bins, heavy_prefixes(seen, tokens, bins, heavy)), least)
    found = found.groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f")).filter(F.col("f") >= least)
    single = words.filter(F.col("f") >= least).select("lang", F.col("word").alias("phrase"), F.lit(1).alias("words"), "f")
    return scored(saved(found.unionByName(single), "phrases"), totals, top)
