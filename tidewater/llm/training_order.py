"""Operator 2, training-order materialisation of token ids.

The tokens of each input partition are concatenated (each document followed by
the end id) and cut into sequences of ``length``; the last sequence of a
partition is padded. A keyed Feistel network over the smallest even power of
two that holds all sequences, walked until the value falls below their number,
is a permutation of 0..n-1: it gives every sequence its global slot without a
sort or a shuffle of its own. Slots are dealt by range to shards, one file per
shard, each a run of records of one fixed size:

    index u8 | first doc_id i8 | first start u4 | tokens u4 | crc32 u4 | ids | zeros

so record r of shard s is slot s x per_shard + r at byte r x stride, and a
reader can stop at any slot and resume there. Spark's text sink writes the
records (its line separator is the run of zero bytes at a record's end), so
any file system that Spark can write will do, and a lost task is repeated by
the ordinary commit protocol.

The documents are tokenised once: the sequences of each input partition go to
a table in the shared folder, numbered within their partition. The permutation
needs the number of all sequences, so one row per partition (its count) passes
the driver before the table is read again, numbered through, and dealt to
shards. What was cut stays as it was cut, whatever partitions a later scan or a
repeated task sees.

Defined cases: null and empty texts give the end id alone; a null id is
written as the smallest long; repeated rows are repeated; other columns are
ignored; an empty table gives no shards.
"""

from __future__ import annotations

import json
import zlib
from typing import Iterator, List, Tuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import partition_bases, saved, slices, texts
from .tokens import encoder

ROUNDS = 6
NO_ID = -(1 << 63)
SLOT_SCHEMA = "slot long, shard long, byte_offset long, sequence long, first_doc_id long, first_start long, n_tokens long, ids_crc32 long, ids binary"


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    x = x + np.uint64(key)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def round_keys(seed: int) -> List[int]:
    return [(seed * 0x9E3779B97F4A7C15 + r * 0xD1342543DE82EF95 + 1) % (1 << 64) for r in range(ROUNDS)]


def _network(x: np.ndarray, half: int, keys: List[int]) -> np.ndarray:
    mask = np.uint64((1 << half) - 1)
    left, right = x >> np.uint64(half), x & mask
    for k in keys:
        left, right = right, left ^ (_mix(right, k) & mask)
    return left << np.uint64(half) | right


def _unnetwork(x: np.ndarray, half: int, keys: List[int]) -> np.ndarray:
    mask = np.uint64((1 << half) - 1)
    left, right = x >> np.uint64(half), x & mask
    for k in reversed(keys):
        left, right = right ^ (_mix(left, k) & mask), left
    return left << np.uint64(half) | right


def _walk(step, index: np.ndarray, total: int, seed: int) -> np.ndarray:
    half = max(1, (max(total - 1, 1).bit_length() + 1) // 2)
    out = step(index.astype(np.uint64), half, round_keys(seed))
    while (beyond := out >= np.uint64(total)).any():  # below 4 steps each on average
        out[beyond] = step(out[beyond], half, round_keys(seed))
    return out.astype(np.int64)


def slot_of(index: np.ndarray, total: int, seed: int) -> np.ndarray:
    """The permutation of 0..total-1."""
    return _walk(_network, np.asarray(index), total, seed)


def index_of(slot: np.ndarray, total: int, seed: int) -> np.ndarray:
    """Its inverse."""
    return _walk(_unnetwork, np.asarray(slot), total, seed)


def stride_of(length: int, width: int) -> int:
    return 28 + length * width + 4


SEQUENCES = "part int, place long, first_doc_id long, first_start long, n_tokens long, body binary"


def sequences(docs: DataFrame, path: str, length: int, end_id: int) -> DataFrame:
    """Saved table of the sequences of (doc_id, text): their partition and place in it, the first
    piece's document and offset, the number of ids before padding, and all ids as compressed bytes
    (about 0.7 of their size, on disk and in the shuffle)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e, part, pack = encoder(path), TaskContext.get().partitionId(), pa.Codec("zstd", 3)
        end = np.array([end_id], e.dtype)
        held: List[Tuple[int, int, np.ndarray]] = []  # (doc_id, start, ids) not yet written
        kept, place = 0, 0

        def rows(done: List[List[Tuple[int, int, np.ndarray]]]) -> pa.RecordBatch:
            nonlocal place
            sizes = [sum(len(p[2]) for p in pieces) for pieces in done]
            pad = [np.full(length - n, end_id, e.dtype) for n in sizes]
            place += len(done)
            return pa.RecordBatch.from_pydict(
                {
                    "part": pa.array(np.full(len(done), part, np.int32)), "place": pa.array(np.arange(place - len(done), place)),
                    "first_doc_id": pa.array([p[0][0] for p in done], pa.int64()), "first_start": pa.array([p[0][1] for p in done], pa.int64()),
                    "n_tokens": pa.array(sizes, pa.int64()),
                    "body": pa.array([pack.compress(np.concatenate([*(p[2] for p in pieces), z]).tobytes(), asbytes=True) for pieces, z in zip(done, pad)], pa.binary()),
                }
            )

        for b in slices(batches):
            ids, ends = e.encode_batch(b.column("text"))
            done: List[List[Tuple[int, int, np.ndarray]]] = []
            for i, doc_id in enumerate(b.column("doc_id").to_pylist()):
                own, at = np.concatenate([ids[ends[i] : ends[i + 1]], end]), 0
                while at < len(own):
                    piece = own[at : at + length - kept]
                    held.append((NO_ID if doc_id is None else doc_id, at, piece))
                    at, kept = at + len(piece), kept + len(piece)
                    if kept == length:
                        done.append(held)
                        held, kept = [], 0
            if done:
                yield rows(done)
        if held:
            yield rows([held])

    return saved(docs.mapInArrow(cut, SEQUENCES), "sequences")


def materialise(
    docs: DataFrame,
    out_dir: str,
    path: str,
    length: int = 2048,
    end_id: int = 1,
    seed: int = 1,
    per_shard: int = 1024,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> dict:
    """Writes ``out_dir``/shards/shard=N/ and ``out_dir``/manifest; returns the manifest."""
    spark = docs.sparkSession
    cut = sequences(texts(docs, id_col, text_col), path, length, end_id)
    # One row per partition, however many sequences it has.
    sizes = cut.groupBy("part").agg((F.max("place") + 1).alias("n"))
    bases = partition_bases(sizes, "part", "n")
    total = cut.count()
    width = encoder(path).dtype.itemsize
    manifest = {
        "sequences": total, "length": length, "id_bytes": width, "per_shard": per_shard, "seed": seed, "rounds": ROUNDS,
        "stride": stride_of(length, width), "end_id": end_id, "shards": -(-total // per_shard),
    }

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            slot = slot_of(b.column("index").to_numpy(), total, seed)
            yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(slot // per_shard), *b.columns], ["slot", "shard", *b.schema.names])

    def record(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = pa.Codec("zstd")
        for b in batches:
            column = lambda c, kind: b.column(c).to_numpy(zero_copy_only=False).astype(kind)
            body = [pack.decompress(x, length * width, asbytes=True) for x in b.column("body").to_pylist()]
            head = np.empty((len(body), 28), np.uint8)
            head[:, :8] = column("index", "<u8")[:, None].view(np.uint8)
            head[:, 8:16] = column("first_doc_id", "<i8")[:, None].view(np.uint8)
            head[:, 16:20] = column("first_start", "<u4")[:, None].view(np.uint8)
            head[:, 20:24] = column("n_tokens", "<u4")[:, None].view(np.uint8)
            head[:, 24:] = np.array([zlib.crc32(x) for x in body], "<u4")[:, None].view(np.uint8)
            yield pa.RecordBatch.from_arrays([b.column("slot"), b.column("shard"), pa.array([h.tobytes() + x for h, x in zip(head, body)], pa.binary())], ["slot", "shard", "record"])

    if total:
        tasks = min(manifest["shards"], max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-manifest["shards"] // 64)))
        each = -(-manifest["shards"] // tasks)
        fields = "index long, first_doc_id long, first_start long, n_tokens long, body binary"
        numbered = cut.join(F.broadcast(bases), "part").withColumn("index", F.col("base") + F.col("place"))
        placed = numbered.select("index", "first_doc_id", "first_start", "n_tokens", "body").mapInArrow(place, f"slot long, shard long, {fields}")
        # Ranges of shards, known beforehand: no sampling pass.
        dealt = placed.repartitionById(tasks, (F.col("shard") / F.lit(each)).cast("int")).mapInArrow(record, "slot long, shard long, record binary")
        dealt = dealt.sortWithinPartitions("shard", "slot")
        dealt.select("shard", F.col("record").cast("string").alias("value")).write.partitionBy("shard").option("lineSep", "\0" * 4).text(f"{out_dir}/shards")
    spark.createDataFrame([(json.dumps(manifest),)], "manifest string").coalesce(1).write.text(f"{out_dir}/manifest")
    return manifest


def read_manifest(spark: SparkSession, out_dir: str) -> dict:
    return json.loads(spark.read.text(f"{out_dir}/manifest").first()[0])


def read_slots(spark: SparkSession, out_dir: str, first: int = 0, count: int | None = None) -> DataFrame:
    """Records from slot ``first`` on, only the shards that hold them being read."""
    m = read_manifest(spark, out_dir)
    last = m["sequences"] if count is None else min(m["sequences"], first + count)
    if first >= last:
        return spark.createDataFrame([], SLOT_SCHEMA)
    per, stride, length, dtype = m["per_shard"], m["stride"], m["length"], np.dtype(f"<u{m['id_bytes']}")

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for shard, raw in zip(b.column("shard").to_pylist(), b.column("content")):
                data = np.frombuffer(raw.as_buffer(), np.uint8)
                if len(data) % stride:
                    raise RuntimeError(f"shard {shard} holds {len(data)} bytes, not a multiple of {stride}")
                rows = data.reshape(-1, stride)
                slot = shard * per + np.arange(len(rows))
                rows, slot = rows[(slot >= first) & (slot < last)], slot[(slot >= first) & (slot < last)]
                field = lambda a, z, kind: np.ascontiguousarray(rows[:, a:z]).view(kind).ravel().astype(np.int64)
                body = [r.tobytes() for r in rows[:, 28 : 28 + length * dtype.itemsize]]
                due, crc = field(24, 28, "<u4"), np.fromiter(map(zlib.crc32, body), np.int64, len(body))
                if (crc != due).any():
                    raise RuntimeError(f"slot {slot[crc != due][0]}: its ids don't have the CRC of its header")
                yield pa.RecordBatch.from_pydict(
                    {
                        "slot": pa.array(slot), "shard": pa.array(slot // per), "byte_offset": pa.array((slot % per) * stride),
                        "sequence": pa.array(field(0, 8, "<u8")), "first_doc_id": pa.array(field(8, 16, "<i8")),
                        "first_start": pa.array(field(16, 20, "<u4")), "n_tokens": pa.array(field(20, 24, "<u4")),
                        "ids_crc32": pa.array(crc), "ids": pa.array(body, pa.binary()),
                    }
                )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(f"{out_dir}/shards")
    wanted = files.filter(F.col("shard").between(first // per, (last - 1) // per))
    return wanted.select(F.col("shard").cast("long").alias("shard"), "content").mapInArrow(parse, SLOT_SCHEMA)
