"""Operator 12, substring dedup: compressed FM-index per shard, matching statistics.

A window is ``length`` consecutive words. Words covered by a window that also
starts in a document with a smaller id are removed; windows are judged on the
input. Two equal windows must meet in one shard, so windows are dealt by their
minimiser, the smallest hash of the ``length * 2 // 5``-word runs inside them: it
depends on the window's words alone, and neighbouring windows mostly share it.
Consecutive windows with the same minimiser are a segment (about 65 words for
windows of 50, never more than 2 x length + 28). Each shard gets an FM-index of
its segments; the segments are then streamed through it by backward search over
the wavelet matrix, and runs of positions whose matching statistics reach
``length`` (in documents with smaller ids) are reported.

Plan: one pass over the texts writes narrow rows (id, place, minimiser, digest
of the segment). Minimisers seen in one document only can't hold a repeat and go
after one aggregate. Equal segments are one pattern: they stand in the index
under the smallest document that has them, so all their windows match for every
other document, and are searched for that smallest one; what is found holds at every
place of the segment there, of which a text that repeats itself has several.
Only those segments' words are fetched, by a join of places and texts. A last
join brings the spans back to the texts.

Skew: copies collapse in the aggregate (min and max of ids, combined in the map
tasks). A minimiser with more than ``limit`` different segments, say of a passage
that a third of all documents quote in different surroundings, is dealt anew
with every window as a segment of its own: equal windows then collapse to one
pattern, and no group is left that holds more than one. Shards have about
``shard_words`` words, so their number grows with the repeated text.

Equality of segments is by 128 bits of two hashes; what a shard compares are the
words themselves.

Defined cases: null and empty texts have no words; a null id is neither smaller
nor larger than any id, so its row loses no word and takes none; rows that repeat
an id don't take words from each other, and each is judged by its own text; very
long texts are cut into segments like others; other columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

from typing import Iterator, List, Tuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WorkerCache, ragged, saved, slices, split_words
from .fm_index import FMIndex, runs

#: Words of a shard, and different segments of one minimiser before it is dealt by windows.
SHARD_WORDS, LIMIT = 400_000, 2_048
#: Bytes of text that a map task hashes at a time.
SLICE = 6 << 20
PLACES = "doc_id long, text_hash long, start int, windows int, key long, digest long"


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class _Rolling:
    """Hash of any run of words in constant time, modulo 2**64."""

    BASE = 0x9E3779B97F4A7C15
    BACK = pow(BASE, -1, 1 << 64)

    def __init__(self, hashes: np.ndarray):
        n = len(hashes)
        power = np.cumprod(np.append(np.uint64(1), np.full(n, self.BASE, np.uint64)))
        self.back = np.cumprod(np.append(np.uint64(1), np.full(n, self.BACK, np.uint64)))
        self.sums = np.append(np.uint64(0), np.cumsum(hashes * power[:-1]))

    def over(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return _mix((self.sums[hi] - self.sums[lo]) * self.back[lo])


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of ``width`` values from each place on (shorter at the end)."""
    pad = np.concatenate([values, np.full(-len(values) % width + width, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    left = np.minimum.accumulate(pad, axis=1).ravel()
    right = np.minimum.accumulate(pad[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: len(values)], left[width - 1 : width - 1 + len(values)])


def _hashed(words: List[str], codes: np.ndarray, cache: WorkerCache) -> Tuple[_Rolling, _Rolling]:
    cache.trim()
    two = np.frombuffer(b"".join([cache[w] for w in words]), "<u8").reshape(-1, 2)
    return _Rolling(two[codes, 0]), _Rolling(two[codes, 1])


def _places(b: pa.RecordBatch, row: np.ndarray, start: np.ndarray, windows: np.ndarray, key: np.ndarray, digest: np.ndarray) -> pa.RecordBatch:
    at = pa.array(row)
    return pa.RecordBatch.from_arrays(
        [b.column("doc_id").take(at), b.column("text_hash").take(at), pa.array(start.astype(np.int32)), pa.array(windows.astype(np.int32)),
         pa.array(key.view(np.int64)), pa.array(digest.view(np.int64))],
        ["doc_id", "text_hash", "start", "windows", "key", "digest"],
    )


def segments(docs: DataFrame, length: int) -> DataFrame:
    """Segments of (doc_id, text_hash, text): windows in a row with the same minimiser."""
    gram = max(1, length * 2 // 5)
    most = length + 28  # windows of a segment at most, where words repeat themselves

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WorkerCache(lambda w: xxhash.xxh3_128_digest(w))
        for b in slices(batches, size=SLICE):
            codes, offsets, words = split_words(b.column("text"))
            n = len(codes)
            if n < length:
                continue
            first, second = _hashed(words, codes, cache)
            row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
            end = offsets[1:][row]
            i = np.arange(n)
            grams = np.full(n, np.iinfo(np.uint64).max, np.uint64)
            fits = np.flatnonzero(i + gram <= end)
            grams[fits] = first.over(fits, fits + gram)
            least = _sliding_min(grams, length - gram + 1)
            at = np.flatnonzero(i + length <= end)  # windows
            if not len(at):
                continue
            new = np.append(True, (least[at[1:]] != least[at[:-1]]) | (np.diff(at) > 1))
            run = np.cumsum(new) - 1
            new |= (np.arange(len(at)) - np.flatnonzero(new)[run]) % most == 0
            lo = at[new]
            count = np.diff(np.append(np.flatnonzero(new), len(at)))
            yield _places(b, row[lo], lo - offsets[row[lo]], count, least[lo], second.over(lo, lo + count + length - 1))

    return docs.mapInArrow(cut, PLACES)


def single_windows(docs: DataFrame, places: DataFrame, length: int) -> DataFrame:
    """Every window of the given places as a segment of its own."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WorkerCache(lambda w: xxhash.xxh3_128_digest(w))
        for b in slices(batches, size=SLICE):
            codes, offsets, words = split_words(b.column("text"))
            first, second = _hashed(words, codes, cache)
            spans = b.column("spans")
            row = np.repeat(np.arange(b.num_rows), np.diff(spans.offsets.to_numpy()))
            inner = spans.flatten()
            count = inner.field("windows").to_numpy().astype(np.int64)
            lo = ragged(offsets[row] + inner.field("start").to_numpy(), count)
            row = np.repeat(row, count)
            yield _places(b, row, lo - offsets[row], np.ones(len(lo), np.int64), first.over(lo, lo + length), second.over(lo, lo + length))

    return _with_spans(docs, places, "start", "windows").mapInArrow(cut, PLACES)


def _with_spans(docs: DataFrame, places: DataFrame, *columns: str, how: str = "inner") -> DataFrame:
    """Texts with the list of their places; each (doc_id, text_hash) once where places are asked for."""
    spans = places.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct(*columns)).alias("spans"))
    if how == "inner":
        docs = docs.dropDuplicates(["doc_id", "text_hash"])
    return docs.join(spans, ["doc_id", "text_hash"], how)


def _texts_of(docs: DataFrame, places: DataFrame, length: int) -> DataFrame:
    """(doc_id, key, digest, windows, words): the words of each place, joined by one space."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            ids, spans = b.column("doc_id"), b.column("spans")
            ends = spans.offsets.to_numpy()
            inner = spans.flatten()
            starts, counts = inner.field("start").to_pylist(), inner.field("windows").to_pylist()
            out: List[bytes] = []
            for r in range(b.num_rows):
                words = b.column("text")[r].as_buffer().to_pybytes().split()  # at ASCII white space
                out += [b" ".join(words[starts[j] : starts[j] + counts[j] + length - 1]) for j in range(ends[r] - ends[0], ends[r + 1] - ends[0])]
            at = pa.array(np.repeat(np.arange(b.num_rows), np.diff(ends)))
            yield pa.RecordBatch.from_arrays([ids.take(at), *(inner.field(c) for c in SEGMENT), pa.array(out, pa.binary())], ["doc_id", *SEGMENT, "words"])

    return _with_spans(docs, places, "start", *SEGMENT).mapInArrow(cut, "doc_id long, key long, digest long, windows int, words binary")


def shard_spans(patterns: DataFrame, shards: int, length: int, depth: int) -> DataFrame:
    """(key, digest, windows, lo, hi): spans of windows, in words of their pattern, that a smaller document of the shard has too."""

    def search(group: pa.Table) -> pa.Table:
        codes, offsets, _ = split_words(group.column("words").combine_chunks().cast(pa.string()))
        lengths = np.diff(offsets)
        owners = np.unique(group.column("doc_id").to_numpy(), return_inverse=True)[1]
        codes = codes.astype(np.int64) + 1
        found = FMIndex(codes, lengths, owners, depth).matching_statistics(codes, lengths, owners)
        segment = np.repeat(np.arange(len(lengths)), lengths)
        a, z = runs(found >= length, segment)
        s = segment[a]
        return pa.table({c: group.column(c).to_numpy()[s] for c in SEGMENT} | {"lo": (a - offsets[s]).astype(np.int32), "hi": (z - offsets[s] + length).astype(np.int32)})

    dealt = patterns.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
    return dealt.groupBy("shard").applyInArrow(search, SPANS)


#: What names a segment whatever its place.
SEGMENT = ("key", "digest", "windows")
SPANS = "key long, digest long, windows int, lo int, hi int"


def repeated_spans(docs: DataFrame, length: int, shard_words: int = SHARD_WORDS, limit: int = LIMIT) -> DataFrame:
    """Spans (lo..hi-1, in words) that smaller documents have too, of (doc_id, text_hash, text) without null ids."""
    out = None
    places, depth, last = saved(segments(docs, length), "segments"), 2 * length + 28, False
    while True:
        same = places.groupBy("key", "digest", "windows").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
        keys = same.groupBy("key").agg(F.min("least").alias("a"), F.max("most").alias("z"), F.count(F.lit(1)).alias("different")).filter("a < z")
        same = saved(same.join(keys.select("key", "different"), "key").select("key", "digest", "windows", "least", "different"), "repeated")
        light = F.lit(True) if last else F.col("different") <= limit
        words, heavy = same.agg(F.sum(F.when(light, F.col("windows") + length - 1)), F.count_if(~light)).first()
        found = saved(places.join(same, ["key", "digest", "windows"]), "places")
        copies = found.filter(light & (F.col("doc_id") > F.col("least"))).select("doc_id", "text_hash", F.col("start").alias("lo"), (F.col("start") + F.col("windows") + length - 1).alias("hi"))
        out = copies if out is None else out.unionByName(copies)
        owned = found.filter(light & (F.col("doc_id") == F.col("least")))
        patterns = owned.groupBy(*SEGMENT).agg(F.min(F.struct("doc_id", "text_hash", "start")).alias("p"))
        patterns = _texts_of(docs, patterns.select("p.*", *SEGMENT), length)
        spans = saved(shard_spans(patterns, max(1, -(-(words or 0) // shard_words)), length, depth), "spans")
        # A pattern can stand at several places of its smallest document, and in several rows of that id.
        out = out.unionByName(owned.join(spans, list(SEGMENT)).select("doc_id", "text_hash", (F.col("start") + F.col("lo")).alias("lo"), (F.col("start") + F.col("hi")).alias("hi")))
        if last or not heavy:
            return out
        places, last = saved(single_windows(docs, found.filter(~light), length), "windows"), True


def repeated_windows_removed(
    docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text", shard_words: int = SHARD_WORDS, limit: int = LIMIT
) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept (the words left, joined by one space)."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    docs = docs.withColumn("text_hash", F.xxhash64("text"))
    spans = repeated_spans(docs.filter("doc_id IS NOT NULL"), length, shard_words, limit)

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            n_words, n_removed, kept = [], [], []
            for text, spans in zip(b.column("text"), b.column("spans").to_pylist()):
                words = text.as_buffer().to_pybytes().split()
                left, at = [], 0
                for s in sorted((s["lo"], s["hi"]) for s in spans or ()):
                    left += words[at : s[0]] if s[0] > at else []
                    at = max(at, s[1])
                left += words[at:]
                n_words.append(len(words))
                n_removed.append(len(words) - len(left))
                kept.append(b" ".join(left))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                ["doc_id", "n_words", "n_removed", "kept"],
            )

    return _with_spans(docs, spans, "lo", "hi", how="left").mapInArrow(strip, "doc_id long, n_words long, n_removed long, kept string")
