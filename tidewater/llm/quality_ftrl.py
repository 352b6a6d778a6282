"""Operator 9, quality classifier: hashed word n-gram logistic regression with
follow-the-regularised-leader (FTRL-proximal) updates.

Features of a text, hashed to 2^18 weights: its words and word pairs, and
n-grams (1 to 3) of the words' shapes (case, digits, trailing symbols, equal to
the word before), each with its relative frequency, and the text's length
class. A score is one sparse dot product through a logistic function.

Training: at most ``max_rows`` labelled rows (a documented bound), dealt by a
hash of their id to shards of about ``rows_per_shard``; in each round every
shard starts from the common state and runs FTRL over its rows, and the
changes are averaged by coordinate over the shards that touched it. What
reaches the driver is bounded by the number of weights.

Defined cases: a null text counts as empty and gets the score of an empty
text; every input row gets one row; without any labelled row all scores are
0.5; a text's length has no bound, it is never cut; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from typing import Iterator, List, Tuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WorkerCache, fold_of, slices, split_words, texts
from .labels import learning_rows

BITS = 18
SIZE = 1 << BITS
BIAS = SIZE
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-4, 1e-3
#: What a relative frequency is multiplied by, by kind of n-gram: words, pairs, shapes.
SCALES = (8.0, 8.0, 4.0)
SHAPES = 18


def _shape(word: str) -> int:
    core = word.rstrip("!?#$%&*+=@^~|<>,.;:)\"'")
    tail = word[len(core) :]
    letters = [c for c in core if c.isalpha()]
    if not letters:
        kind = 3 if core else 4
    elif any(c.isdigit() for c in core):
        kind = 5
    elif len(letters) > 1 and core.isupper():
        kind = 2
    else:
        kind = 1 if core[0].isupper() else 0
    return kind * 3 + (0 if not tail else 1 if re.fullmatch("[,.;:)\"']+", tail) else 2)


def _coded_word(word: str) -> int:
    return xxhash.xxh32_intdigest(word) << 8 | _shape(word)


_WORDS = WorkerCache(_coded_word, 600_000)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _bucket(x: np.ndarray, kind: int) -> np.ndarray:
    x = (x + np.uint64(kind + 1)) * _MIX
    x ^= x >> np.uint64(29)
    return (x * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - BITS)).astype(np.int64)


def features(text: pa.Array) -> Tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, weight index, value) of all n-grams of a batch, repeats not yet summed."""
    codes, offsets, words = split_words(text)
    _WORDS.trim()
    word = np.array([_WORDS[w] for w in words], np.uint64)[codes] if words else np.zeros(0, np.uint64)
    n = np.diff(offsets)
    rows = len(n)
    row = np.repeat(np.arange(rows), n)
    lexical, shape = word >> np.uint64(8), word & np.uint64(255)
    same = np.zeros(len(codes), bool)
    if len(codes) > 1:
        same[1:] = (codes[1:] == codes[:-1]) & (row[1:] == row[:-1])
    shape = shape + np.where(same, SHAPES, 0).astype(np.uint64)
    share = 1.0 / np.maximum(n, 1)
    out: List[Tuple[np.ndarray, np.ndarray, np.ndarray]] = [(row, _bucket(lexical, 0), share[row] * SCALES[0])]
    pair = row[1:] == row[:-1]
    at = np.flatnonzero(pair)
    out.append((row[at], _bucket(lexical[at] * np.uint64(0xD1342543DE82EF95) + lexical[at + 1], 1), share[row[at]] * SCALES[1]))
    out.append((row, _bucket(shape, 2), share[row] * SCALES[2]))
    two = shape[at] << np.uint64(8) | shape[at + 1]
    out.append((row[at], _bucket(two, 3), share[row[at]] * SCALES[2]))
    third = np.flatnonzero(pair[1:] & pair[:-1])
    three = shape[third] << np.uint64(16) | shape[third + 1] << np.uint64(8) | shape[third + 2]
    out.append((row[third], _bucket(three, 4), share[row[third]] * SCALES[2]))
    length = np.floor(np.log2(n + 1)).astype(np.uint64)
    out.append((np.arange(rows), _bucket(length, 5), np.ones(rows)))
    out.append((np.arange(rows), np.full(rows, BIAS), np.ones(rows)))
    return tuple(np.concatenate(c) for c in zip(*out))  # type: ignore[return-value]


def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def ftrl(z: np.ndarray, n: np.ndarray, index: np.ndarray, value: np.ndarray, label: int) -> None:
    """One row's update of the state in place."""
    w = weights(z[index], n[index])
    p = 1 / (1 + math.exp(-max(-30.0, min(30.0, float(w @ value)))))
    g = (p - label) * value
    sigma = (np.sqrt(n[index] + g * g) - np.sqrt(n[index])) / ALPHA
    z[index] += g - sigma * w
    n[index] += g * g


def train(rows: DataFrame, max_rows: int, rows_per_shard: int, rounds: int) -> np.ndarray:
    """Weights learnt from (doc_id, text, label)."""
    spark = rows.sparkSession
    shards = max(1, -(-max_rows // rows_per_shard))
    dealt = rows.repartition(shards, F.xxhash64("doc_id") % (shards * 8)).sortWithinPartitions(F.xxhash64("doc_id", F.lit(1)))
    z, n = np.zeros(SIZE + 1), np.zeros(SIZE + 1)
    for _ in range(rounds):
        state = spark.sparkContext.broadcast((z, n))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            z0, n0 = state.value
            z1, n1 = z0.copy(), n0.copy()
            for b in slices(batches):
                row, index, value = features(b.column("text"))
                order = np.argsort(row, kind="stable")
                ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=b.num_rows))])
                for i, label in enumerate(b.column("label").to_pylist()):
                    own = order[ends[i] : ends[i + 1]]
                    at, where = np.unique(index[own], return_inverse=True)
                    ftrl(z1, n1, at, np.bincount(where, value[own]), label)
            at = np.flatnonzero(n1 != n0)
            if len(at):
                yield pa.RecordBatch.from_pydict({"at": pa.array(at), "dz": pa.array(z1[at] - z0[at]), "dn": pa.array(n1[at] - n0[at])})

        changes = dealt.mapInArrow(run, "at long, dz double, dn double").groupBy("at").agg(F.avg("dz").alias("dz"), F.avg("dn").alias("dn")).toArrow()
        at = changes["at"].to_numpy()
        z, n = z.copy(), n.copy()
        z[at] += changes["dz"].to_numpy()
        n[at] += changes["dn"].to_numpy()
    return weights(z, n)


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    threshold: float = 0.3,
    max_rows: int = 20_000,
    rows_per_shard: int = 2_500,
    rounds: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, held_out, score (probability of label 1), predicted."""
    rows = texts(docs, id_col, text_col)
    model = docs.sparkSession.sparkContext.broadcast(train(learning_rows(rows, labels, label, max_rows), max_rows, rows_per_shard, rounds))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            row, index, value = features(b.column("text"))
            margin = np.bincount(row, model.value[index] * value, b.num_rows)
            p = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "held_out": b.column("held_out"), "score": pa.array(p), "predicted": pa.array((p >= threshold).astype(np.int32))})

    held = rows.withColumn("held_out", fold_of("doc_id", 5) == 0)
    return held.mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int")
