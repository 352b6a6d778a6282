"""Operator 8, packing: space-filling-curve order.

Every document becomes a hashed count vector of its token ids (signed buckets,
unit length), projected by a fixed random matrix to a few dimensions and
quantised; the Hilbert key of that cell orders the documents, so neighbours
along the curve use similar words. Documents are concatenated in (key, row)
order and cut every ``length`` tokens: only the last sequence is padded.

Plan: tokenise once into a table in the shared folder (ids as 16-bit integers
when the vocabulary allows); range-sort only (row, key, token count); running
totals within each range partition plus one base per partition give every
document its global start; one shuffle brings start and ids together, and the
cuts are made where the ids lie. Equal keys (copies) are told apart by the row
number, so a group of copies of any size is spread over the range partitions.

Defined cases: null and empty texts consist of the end id alone; ids may be
null or repeat, every row is packed on its own; other columns are ignored; an
empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partition_bases, saved, slices, texts
from .tokens import encoder

BUCKETS, DIMENSIONS, BITS = 256, 4, 12


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert keys of integer cells (rows x dimensions), by Skilling's transform."""
    x = [c.astype(np.int64) for c in cells.T]
    d = len(x)
    for s in range(bits - 1, 0, -1):
        q, p = 1 << s, (1 << s) - 1
        for i in range(d):
            swap = (x[0] ^ x[i]) & p
            on = (x[i] & q) != 0
            x[0] ^= np.where(on, p, swap)
            if i:
                x[i] ^= np.where(on, 0, swap)
    for i in range(1, d):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    for s in range(bits - 1, 0, -1):
        t ^= np.where(x[-1] & (1 << s), (1 << s) - 1, 0)
    key = np.zeros_like(t)
    for s in range(bits - 1, -1, -1):
        for c in x:
            key = key << 1 | ((c ^ t) >> s & 1)
    return key


def curve_keys(ids: np.ndarray, ends: np.ndarray, vocabulary: int) -> np.ndarray:
    """Hilbert key of each document's hashed and projected vector."""
    rng = np.random.default_rng(20_240)
    bucket = rng.integers(0, BUCKETS, vocabulary)
    sign = rng.choice([-1.0, 1.0], vocabulary)
    matrix = rng.standard_normal((BUCKETS, DIMENSIONS))
    n = len(ends) - 1
    row = np.repeat(np.arange(n), np.diff(ends))
    vectors = np.bincount(row * BUCKETS + bucket[ids], sign[ids], n * BUCKETS).reshape(n, BUCKETS)
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    spots = vectors @ matrix / np.where(norm == 0, 1, norm)
    share = 1 / (1 + np.exp(-1.702 * spots))  # about uniform for random directions
    return hilbert(np.minimum((share * (1 << BITS)).astype(np.int64), (1 << BITS) - 1), BITS)


def tokenised(docs: DataFrame, path: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """Saved table (row, doc_id, key, n, ids): ids with the end id, as little-endian bytes."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        end = np.array([end_id], e.dtype).tobytes()
        for b in slices(batches):
            ids, ends = e.encode_batch(b.column("text"))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": b.column("doc_id"),
                    "key": pa.array(curve_keys(ids, ends, e.vocab_size)),
                    "n": pa.array(np.diff(ends) + 1),
                    "ids": pa.array([ids[a:z].tobytes() + end for a, z in zip(ends, ends[1:])], pa.binary()),
                }
            )

    rows = texts(docs, id_col, text_col).mapInArrow(encode, "doc_id long, key long, n long, ids binary")
    return saved(rows.withColumn("row", F.monotonically_increasing_id()), "tokens")


def starts_in_order(rows: DataFrame) -> DataFrame:
    """(row, start): global token position of each row in (key, row) order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for b in batches:
            n = b.column("n").to_numpy()
            ends = at + np.cumsum(n)
            if len(n):
                yield pa.RecordBatch.from_pydict(
                    {"part": pa.array([part] * len(n), pa.int32()), "row": b.column("row"), "run": pa.array(ends - n), "n": b.column("n")}
                )
                at = int(ends[-1])

    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    light = rows.select("row", "key", "n").repartitionByRange(width, "key", "row").sortWithinPartitions("key", "row")
    light = saved(light.mapInArrow(run, "part int, row long, run long, n long"), "starts")
    bases = partition_bases(light.groupBy("part").agg(F.sum("n").alias("n")), "part", "n")
    return light.join(F.broadcast(bases), "part").select("row", (F.col("base") + F.col("run")).alias("at"))


def pack(
    docs: DataFrame, path: str, length: int = 2048, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset (and the piece's ids when asked for)."""
    rows = tokenised(docs, path, end_id, id_col, text_col)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype = encoder(path).dtype
        for b in batches:
            out = []
            for doc_id, at, n, raw in zip(*(b.column(c).to_pylist() for c in ("doc_id", "at", "n", "ids"))):
                ids, start = np.frombuffer(raw, dtype).astype("<u4"), 0
                while start < n:
                    sequence, offset = divmod(at + start, length)
                    size = min(n - start, length - offset)
                    piece = ids[start : start + size]
                    out.append((doc_id, start, size, zlib.crc32(piece.tobytes()), n, sequence, offset, piece if with_ids else None))
                    start += size
            if out:
                columns = [pa.array(c, pa.int64()) for c in list(zip(*out))[:7]]
                columns += [pa.array([p.astype(np.int64) for p in list(zip(*out))[7]], pa.list_(pa.int64()))] if with_ids else []
                yield pa.RecordBatch.from_arrays(columns, NAMES + ["ids"] * with_ids)

    schema = ", ".join(f"{c} long" for c in NAMES) + ", ids array<long>" * with_ids
    return rows.join(starts_in_order(rows), "row").select("doc_id", "at", "n", "ids").mapInArrow(cut, schema)


NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
