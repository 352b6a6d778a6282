"""Operator 4, n-gram Jaccard join: Bayesian candidate pruning.

Texts are sets of shingles of five words (white-space words, A-Z lower-cased; a
shorter text is one shingle). A pair is linked when the Jaccard similarity of
its sets is at least ``threshold``.

1. Every text gets 128 MinHash values. Texts with the same set form a class;
   from here on one representative stands for each class, so copies are never
   paired.
2. Candidates share one of 32 bands of 4 values (a pair at 0.8 is missed with
   probability 5e-8). Buckets of two or more members are cut into blocks of
   about 2,048 members or 2 million shingles, and block meets block in a task
   of its own: a bucket of any size has bounded tasks, and no pair is a row.
3. In each block pair, MinHash values are compared 32 at a time; a pair is
   dropped when the posterior probability that its similarity reaches the
   threshold (uniform prior) falls below ``tolerance``. A pair is handled only
   in its first common band.
4. Members that keep a partner are joined with their texts, and the kept pairs
   are verified by their exact sets of 64-bit shingle hashes. A block pair
   returns one row per linked member: the copies it is linked to, and the
   smallest class of its group. Counts add up over block pairs; the groups are
   joined into connected components on tables.

``near_duplicates`` returns one row per document: class_id (smallest doc_id of
its component), n_links (other documents at or above the threshold, copies
included), copies (documents with the same set, itself included).

Defined cases: null and empty texts have no shingle, no links and a class of
their own; a null id counts among its class's copies, and a class with only null
ids is linked like others and named by the smallest id of its group, null where
there is none; rows that repeat an id with the same set count as copies, an id
on two texts is judged by each of them; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from typing import Iterator, List, Tuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ASCII_SPACE, row_hash, saved, slices, split_words, texts, without
from .graph import components

WORDS, HASHES, ROWS = 5, 128, 4
BANDS = HASHES // ROWS
STEP = 32
BLOCK_MEMBERS, BLOCK_SHINGLES = 2_048, 2_000_000
TOLERANCE = 1e-9
_RNG = np.random.default_rng(4)
_A = _RNG.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 1 << 63, HASHES, dtype=np.uint64)
_C = _RNG.integers(0, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(text: pa.Array) -> List[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    codes, offsets, words = split_words(pc.ascii_lower(text))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))[codes] if words else np.zeros(0, np.uint64)
    n = len(hashes)
    joined = np.zeros(max(0, n - WORDS + 1), np.uint64)
    for i in range(WORDS):
        joined += hashes[i : i + len(joined)] * _C[i]
    joined = mix(joined)
    out = []
    for a, b in zip(offsets, offsets[1:]):
        if b - a >= WORDS:
            out.append(np.unique(joined[a : b - WORDS + 1]))
        elif b > a:
            out.append(mix((hashes[a:b] * _C[: b - a]).sum(keepdims=True, dtype=np.uint64) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signatures(sets: List[np.ndarray]) -> np.ndarray:
    """(sets x 128) 16-bit marks of the MinHash values; zeros for an empty set."""
    out = np.zeros((len(sets), HASHES), np.uint16)
    some = [i for i, s in enumerate(sets) if len(s)]
    if some:
        flat = np.concatenate([sets[i] for i in some])
        starts = np.cumsum([0] + [len(sets[i]) for i in some[:-1]])
        for h in range(HASHES):
            out[some, h] = np.minimum.reduceat(flat * _A[h] + _B[h], starts).astype(np.uint16)
    return out


def least_matches(threshold: float, tolerance: float) -> List[Tuple[int, int]]:
    """(values compared, least number that must agree) for each step.

    With a uniform prior, P(similarity >= t | m of k agree) = P(Binomial(k + 1, t) <= m).
    """
    out = []
    for k in range(STEP, HASHES + 1, STEP):
        total, m = 0.0, 0
        while True:
            total += math.comb(k + 1, m) * threshold**m * (1 - threshold) ** (k + 1 - m)
            if total >= tolerance:
                break
            m += 1
        out.append((k, m))
    return out


def _pairs(starts: np.ndarray, sizes: np.ndarray) -> Iterator[Tuple[np.ndarray, np.ndarray]]:
    """Index pairs inside each run, in chunks of bounded size."""
    for size in np.unique(sizes[sizes > 1]):
        at = starts[sizes == size]
        if size <= 512:
            a, b = np.triu_indices(int(size), 1)
            for part in np.array_split(at, -(-len(at) * len(a) // 200_000)):
                yield (part[:, None] + a).ravel(), (part[:, None] + b).ravel()
        else:
            rows = max(1, 200_000 // int(size))
            for s in at:
                for r in range(0, int(size), rows):
                    a, b = np.meshgrid(np.arange(r, min(r + rows, size)), np.arange(r, size), indexing="ij")
                    keep = a < b
                    yield s + a[keep], s + b[keep]


def kept_pairs(group: pa.Table, sig: np.ndarray, steps: List[Tuple[int, int]]) -> Iterator[Tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of the same block pair that this band is the first to join and that aren't pruned."""
    run, band, block = (group[c].to_numpy() for c in ("run", "band", "block"))
    cross = group["lo"].to_numpy() != group["hi"].to_numpy()
    starts = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
    sizes = np.diff(np.append(starts, len(run)))
    keys = sig.view("<u8")
    for a, b in _pairs(starts, sizes):
        ok = ~cross[a] | (block[a] != block[b])
        a, b = a[ok], b[ok]
        first = (keys[a] == keys[b]).argmax(axis=1) == band[a]
        a, b = a[first], b[first]
        same = np.zeros(len(a), np.int64)
        for k, least in steps:
            same += (sig[a, k - STEP : k] == sig[b, k - STEP : k]).sum(axis=1)
            ok = same >= least
            a, b, same = a[ok], b[ok], same[ok]
        if len(a):
            yield a, b


def whole_runs(batches: Iterator[pa.RecordBatch], bytes_column: str = "") -> Iterator[pa.Table]:
    """Tables of whole block pairs (consecutive rows with the same band, key, lo, hi), with a run number."""
    held: List[pa.RecordBatch] = []

    def numbered(t: pa.Table) -> np.ndarray:
        change = np.zeros(t.num_rows, bool)
        for c in ("band", "key", "lo", "hi"):
            col = t[c].combine_chunks()
            change[1:] |= pc.not_equal(col[1:], col[:-1]).to_numpy(zero_copy_only=False)
        return np.cumsum(change)

    rows = size = 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        rows, size = rows + b.num_rows, size + (b.column(bytes_column).nbytes if bytes_column else 0)
        if rows < 20_000 and size < 8 << 20:
            continue
        t = pa.Table.from_batches(held)
        run = numbered(t)
        cut = int(np.searchsorted(run, run[-1]))  # the last one may go on
        if cut:
            yield t.slice(0, cut).append_column("run", pa.array(run[:cut]))
        held = t.slice(cut).combine_chunks().to_batches()
        rows, size = t.num_rows - cut, 0
    if held:
        t = pa.Table.from_batches(held)
        yield t.append_column("run", pa.array(numbered(t)))


def _marks(t: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(t["sig"].to_pylist()), "<u2").reshape(-1, HASHES)


def jaccard(sets: List[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact similarity of each pair of sets."""
    out = np.zeros(len(a))
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    rows, cols = np.unique(a), np.unique(b)
    if len(a) < 4 * (len(rows) + len(cols)):
        for i, (x, y) in enumerate(zip(a, b)):
            s, t = sets[x], sets[y]
            if len(s) > len(t):
                s, t = t, s
            at = np.minimum(np.searchsorted(t, s), len(t) - 1)
            out[i] = np.count_nonzero(t[at] == s)
    else:  # many pairs of the same members: products of small incidence matrices
        for r in _tiles(rows, size):
            for c in _tiles(cols, size):
                pick = np.flatnonzero(np.isin(a, r) & np.isin(b, c))
                if len(pick):
                    out[pick] = _overlap(sets, r, c)[np.searchsorted(r, a[pick]), np.searchsorted(c, b[pick])]
    return out / np.maximum(1, size[a] + size[b] - out)


def _tiles(members: np.ndarray, size: np.ndarray) -> Iterator[np.ndarray]:
    """Runs of at most 256 members and about 60,000 shingles."""
    at = 0
    while at < len(members):
        total = np.cumsum(size[members[at : at + 256]])
        n = max(1, int(np.searchsorted(total, 60_000, "right")))
        yield members[at : at + n]
        at += n


def _overlap(sets: List[np.ndarray], rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    left, right = [sets[i] for i in rows], [sets[i] for i in cols]
    shared = np.intersect1d(np.concatenate(left), np.concatenate(right))

    def matrix(parts: List[np.ndarray]) -> np.ndarray:
        flat, row = np.concatenate(parts), np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        at = np.minimum(np.searchsorted(shared, flat), max(0, len(shared) - 1))
        hit = shared[at] == flat if len(shared) else np.zeros(len(flat), bool)
        m = np.zeros((len(parts), len(shared)), np.float32)
        m[row[hit], at[hit]] = 1
        return m

    return np.rint(matrix(left) @ matrix(right).T).astype(np.int64)


def smallest_in_group(node: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For rows with value ``node`` linked by (a, b): the smallest value reachable."""
    label = node.copy()
    while True:
        low = label.copy()
        np.minimum.at(low, a, label[b])
        np.minimum.at(low, b, label[a])
        if (low == label).all():
            return label
        label = low


def signed_texts(rows: DataFrame) -> DataFrame:
    """Saved (doc_id, row_hash, n, digest, sig) of every text; id and hash tell rows apart."""
    rows = rows.withColumn("row_hash", row_hash(F.col("text")))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            sets = shingle_sets(b.column("text"))
            sig = signatures(sets)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": b.column("doc_id"),
                    "row_hash": b.column("row_hash"),
                    "n": pa.array([len(s) for s in sets], pa.int64()),
                    "digest": pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                    "sig": pa.array([s.tobytes() for s in sig], pa.binary()),
                }
            )

    return saved(rows.mapInArrow(sign, "doc_id long, row_hash long, n long, digest binary, sig binary"), "signatures")


def linked(rows: DataFrame, classes: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """Saved (cid, links, root): for each class and block pair with a link, the copies linked and the group's smallest class."""
    steps = least_matches(threshold, tolerance)
    real = classes.filter("n > 0")
    # Static values for the closures below; the tables stay lazy.
    keyed = real.select("cid", "n", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.substring("sig", i * 8 + 1, F.lit(8)))).alias("band", "key"))
    buckets = keyed.groupBy("band", "key").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("shingles")).filter("members > 1")
    blocks = F.ceil(F.greatest(F.col("members") / BLOCK_MEMBERS, F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    buckets = buckets.select("band", "key", blocks.alias("blocks"))
    member = keyed.join(buckets, ["band", "key"]).withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    member = member.select("cid", "band", "key", "block", other.alias("other")).select(
        "cid", "band", "key", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi")
    )
    group = ["band", "key", "lo", "hi"]

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_runs(batches):
            keep = np.zeros(t.num_rows, bool)
            for a, b in kept_pairs(t, _marks(t), steps):
                keep[a] = keep[b] = True
            yield from t.filter(pa.array(keep)).select(["cid", *group, "block"]).combine_chunks().to_batches()

    grouped = member.join(real.select("cid", "sig"), "cid").repartition(*group).sortWithinPartitions(*group)
    schema = "cid long, band int, key binary, lo int, hi int, block int"
    kept = saved(grouped.select("cid", *group, "block", "sig").mapInArrow(prune, schema), "kept")

    # The class's own text: by id and hash, since an id may occur with other texts too, or be null.
    wanted = kept.select("cid").distinct().join(real, "cid").select("cid", "rep", "rep_hash", "copies", "sig")
    mine = F.col("doc_id").eqNullSafe(F.col("rep")) & (row_hash(F.col("text")) == F.col("rep_hash"))
    texts_of = saved(rows.join(wanted, mine).select("cid", "copies", "sig", "text").dropDuplicates(["cid"]), "texts")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_runs(batches, "text"):
            sig, sets = _marks(t), shingle_sets(t["text"].combine_chunks())
            cid, copies = t["cid"].to_numpy(), t["copies"].to_numpy()
            links = np.zeros(len(cid), np.int64)
            edges_a, edges_b = [], []
            for a, b in kept_pairs(t, sig, steps):
                ok = jaccard(sets, a, b) >= threshold
                a, b = a[ok], b[ok]
                np.add.at(links, a, copies[b])
                np.add.at(links, b, copies[a])
                edges_a.append(a)
                edges_b.append(b)
            if edges_a:
                some = np.flatnonzero(links)
                root = smallest_in_group(cid, np.concatenate(edges_a), np.concatenate(edges_b))
                yield pa.RecordBatch.from_pydict({"cid": pa.array(cid[some]), "links": pa.array(links[some]), "root": pa.array(root[some])})

    grouped = kept.join(texts_of, "cid").repartition(*group).sortWithinPartitions(*group)
    return saved(grouped.select("cid", *group, "block", "copies", "sig", "text").mapInArrow(verify, "cid long, links long, root long"), "links")


def _grouped(docs: DataFrame, threshold: float, tolerance: float, id_col: str, text_col: str) -> DataFrame:
    """doc_id, row_hash, root (of the group; null: none), class_id, n_links, copies, n_shingles, digest; one row per input row."""
    rows = texts(docs, id_col, text_col)
    signed = signed_texts(rows)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_hash", "n", "sig")).alias("first")
    classes = signed.groupBy("digest").agg(first, F.count(F.lit(1)).alias("copies"))
    classes = saved(classes.select(F.monotonically_increasing_id().alias("cid"), "digest", "copies", F.col("first.doc_id").alias("rep"), F.col("first.row_hash").alias("rep_hash"), "first.n", "first.sig"), "classes")
    links = linked(rows, classes, threshold, tolerance)
    roots = components(links.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    named = roots.join(classes.select(F.col("cid").alias("node"), "rep"), "node")
    names = named.groupBy("root").agg(F.min("rep").alias("class_id"))
    per_class = roots.join(names, "root").select(F.col("node").alias("cid"), "root", "class_id")
    counts = links.groupBy("cid").agg(F.sum("links").alias("links"))
    known = classes.select("cid", "digest", "copies", "rep").join(per_class, "cid", "left").join(counts, "cid", "left")
    out = signed.select("doc_id", "row_hash", "n", "digest").join(known, "digest")
    empty = F.col("n") == 0
    return out.select(
        "doc_id",
        "row_hash",
        F.when(~empty, F.coalesce("root", "cid")).alias("root"),
        F.when(empty, F.col("doc_id")).otherwise(F.coalesce("class_id", "rep")).alias("class_id"),
        F.when(empty, F.lit(0)).otherwise(F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"),
        F.when(empty, F.lit(1)).otherwise(F.col("copies")).cast("long").alias("copies"),
        F.col("n").alias("n_shingles"),
    )


def near_duplicates(docs: DataFrame, threshold: float = 0.8, tolerance: float = TOLERANCE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, class_id, n_links, copies, n_shingles; one row per input row."""
    return _grouped(docs, threshold, tolerance, id_col, text_col).drop("row_hash", "root")


def drop_near_duplicates(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group: that with the smallest id (null ids last, then by text).

    Rows are told apart by id and text, so null and repeated ids are judged like
    others; of rows that repeat both, one stays. Texts without words all stay.
    """
    rows = saved(_grouped(docs, threshold, TOLERANCE, id_col, text_col).filter("root IS NOT NULL").select("root", "doc_id", "row_hash"), "groups")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_hash")).alias("first")
    stay = rows.groupBy("root").agg(first).select("root", F.col("first.doc_id").alias("first_id"), F.col("first.row_hash").alias("first_hash"))
    judged = rows.join(stay, "root").withColumn("stays", F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("row_hash") == F.col("first_hash")))
    judged = saved(judged.select("doc_id", "row_hash", "stays"), "judged")
    gone = judged.filter("NOT stays").select("doc_id", "row_hash").distinct()
    wordless = ~F.coalesce(F.col(text_col), F.lit("")).rlike(f"[^{ASCII_SPACE[1:-2]}]")
    full = without(docs.filter(~wordless), gone, judged.filter("stays"), id_col, text_col)
    return full.unionByName(docs.filter(wordless))
