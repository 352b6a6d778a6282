"""Operator 6, language-model scoring: hidden Markov model.

Tokens are white-space words (A-Z lower-cased) and one end per text. Every word
that the learning texts have OWN times or more has emissions of its own, a row
of STATES expected counts. Rarer and unknown words are emitted through a class,
their last two bytes (65,792 classes whatever the vocabulary): given its class,
a rare word has the smoothed share (c + 1) / (sum of (c + 1) over the class,
+ 1), and any unknown word the rest. State emissions are smoothed towards the
unigram shares, so the model is a proper distribution over texts.

The emissions are a table and never meet in one place:

- Texts are encoded once, in blocks of about BLOCK_TOKENS tokens with a
  vocabulary of their own. A block's words go to word shards by hash, one row
  for each block and shard; a shard adds up the counts and keeps its words' rows.
- Training (Baum-Welch): in each round every shard sends each block the rows of
  the block's words (one binary value for block and shard, 28 bytes a word), blocks run the scaled
  forward-backward recursion over their learning texts and send the expected
  counts back, and shards add them up. The driver gets the expected transitions,
  starts and class counts, summed by Spark: 65,805 rows at most. Every round runs
  over all learning texts; rounds end when the learning texts' log10 likelihood
  rises by less than ``gain`` a token, or after ``rounds``.
- Scoring: scaled forward recursion over the whole text, exact in 64 bits.

Texts of any length are handled in stretches of STRETCH tokens, all texts of a
block side by side; the forward variable is carried over the border, so scores
are exact. In training the backward variable starts anew at a border (the one
place where a long text's counts differ from an uncut recursion).

Defined cases: a null text counts as empty (one token, the end); a null id is a
learning row; repeated rows count repeatedly; without any learning row every
score is 0, as the base formula gives; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Dict, Iterator, List, Optional, Tuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, fold_of, ragged, shared_path, slices, texts

#: Occurrences from which a word has emissions of its own, and classes of the others.
OWN, CLASSES = 3, 65_792
#: Tokens of a block, and bytes of text that a shard of words stands for.
BLOCK_TOKENS, SHARD_BYTES = 4_000_000, 24 << 20
STATES, SMOOTH = 12, 100.0
STRETCH, CHUNK = 1_024, 150_000
#: Steps after which the recursions are scaled again.
RESCALE = 4
#: Removes a query's shuffle files when it ends; set on a session of this operator's own.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


# ---------------------------------------------------------------------------
# The recursions
# ---------------------------------------------------------------------------


class Steps:
    """Sequences laid out by time step, longest first, so that each step is one run of rows."""

    def __init__(self, sequences: List[np.ndarray]):
        length = np.fromiter(map(len, sequences), np.int64, len(sequences))
        self.order = np.argsort(-length, kind="stable")
        self.length = length = length[self.order]
        self.alive = np.searchsorted(-length, -np.arange(length[0] if len(length) else 0), "left")  # sequences longer than t
        self.at = np.concatenate([[0], np.cumsum(self.alive)])
        t = ragged(np.zeros(len(length), np.int64), length)
        self.sequence = np.zeros(len(t), np.int64)
        place = self.at[t] + np.repeat(np.arange(len(length)), length)
        self.sequence[place] = np.repeat(np.arange(len(length)), length)
        self.symbol = np.zeros(len(t), np.int64)
        if len(t):
            self.symbol[place] = np.concatenate([sequences[i] for i in self.order])
        self.last = self.at[np.maximum(length - 1, 0)] + np.arange(len(length))


@dataclass
class Model:
    start: np.ndarray  # K
    move: np.ndarray  # K x K
    emit: np.ndarray  # symbols x K

    def __post_init__(self):
        self.peak = self.emit.max(axis=1)
        self.height = np.log10(self.peak.astype(np.float64))

    def forward(self, s: Steps, first: np.ndarray, every: int = RESCALE) -> Tuple[np.ndarray, np.ndarray, Dict[int, np.ndarray], np.ndarray, np.ndarray]:
        """Alphas and emissions of every token by time step, the factors taken out of the steps scaled,
        and the sums of each sequence's last alphas and its log10 likelihood; ``first`` has its states before it.
        Emissions are shares of their symbol's largest. Where few steps together get near the
        smallest numbers, each step is scaled."""
        e = self.emit[s.symbol]
        e /= self.peak[s.symbol][:, None]
        likelihood = np.bincount(s.sequence, self.height[s.symbol], len(s.length))
        alpha, scales, ones = np.empty_like(e), {}, np.ones(e.shape[1], e.dtype)
        a = None
        for t, (at, n) in enumerate(zip(s.at.tolist(), s.alive.tolist())):
            now = alpha[at : at + n]
            if a is None:
                now[:] = first
            else:
                np.dot(a[:n], self.move, out=now)
            now *= e[at : at + n]
            a = now
            if t % every == every - 1:
                scales[t] = total = a @ ones
                if every > 1 and not total.min() > np.finfo(e.dtype).tiny * 1e22:
                    return self.forward(s, first, 1)
                a /= total[:, None]
        ends = alpha[s.last] @ ones
        if every > 1 and not ends.min() > np.finfo(e.dtype).tiny * 1e22:
            return self.forward(s, first, 1)
        for total in [*scales.values(), ends]:
            likelihood[: len(total)] += np.log10(total)
        return alpha, e, scales, ends, likelihood

    def _waves(self, sequences: List[np.ndarray], stretch: int) -> Iterator[Tuple[np.ndarray, Steps]]:
        """The sequences' first stretches side by side, then the second ones of the longer sequences, and so on."""
        length = np.fromiter(map(len, sequences), np.int64, len(sequences))
        for a in range(0, int(length.max(initial=0)), stretch):
            live = np.flatnonzero(length > a)
            s = Steps([sequences[i][a : a + stretch] for i in live])
            yield live[s.order], s

    def log10(self, sequences: List[np.ndarray], stretch: Optional[int] = None) -> np.ndarray:
        """log10 likelihood of each sequence."""
        out = np.zeros(len(sequences))
        before = np.tile(self.start, (len(sequences), 1))
        for who, s in self._waves(sequences, stretch or STRETCH):
            alpha, _, _, ends, likelihood = self.forward(s, before[who])
            out[who] += likelihood
            before[who] = (alpha[s.last] / ends[:, None]) @ self.move
        return out

    def expected(self, sequences: List[np.ndarray], emit: np.ndarray, move: np.ndarray, start: np.ndarray, stretch: Optional[int] = None) -> float:
        """Adds the expected counts of forward-backward; the sequences' log10 likelihood."""
        before, ends, likelihood = np.tile(self.start, (len(sequences), 1)), None, 0.0
        for who, s in self._waves(sequences, stretch or STRETCH):
            alpha, weighted, scales, total, found = self.forward(s, before[who])
            likelihood += float(found.sum())
            beta, back = np.empty_like(alpha), np.ascontiguousarray(self.move.T)
            beta[s.last] = 1 / total[:, None]
            at, alive = s.at.tolist(), s.alive.tolist()
            for t in range(len(alive) - 1, -1, -1):
                later = slice(at[t], at[t] + alive[t])
                w = weighted[later]
                w *= beta[later]
                if t in scales:
                    w /= scales[t][:, None]
                if t:
                    np.dot(w, back, out=beta[at[t - 1] : at[t - 1] + alive[t]])
            n, last = alive[0], alpha[s.last] / total[:, None]
            goes_on = np.ones(len(alpha), bool)
            goes_on[s.last] = False
            move += (alpha[goes_on].T @ weighted[n:]) * self.move
            gamma = np.multiply(alpha, beta, out=beta)
            if ends is None:
                start += gamma[:n].sum(axis=0)
                ends = np.empty((len(sequences), len(self.start)), alpha.dtype)
            else:  # the step over the border
                move += (ends[who].T @ weighted[:n]) * self.move
            for k in range(gamma.shape[1]):
                np.add.at(emit[:, k], s.symbol, gamma[:, k].astype(emit.dtype))
            ends[who] = last
            before[who] = last @ self.move
        return likelihood


def grouped(sequences: List[np.ndarray]) -> Iterator[List[int]]:
    """Sequences in groups of about CHUNK tokens a stretch, by length: as many long ones go side by side as short ones."""
    held: List[int] = []
    size = 0
    for i in sorted(range(len(sequences)), key=lambda i: len(sequences[i])):
        held.append(i)
        size += min(len(sequences[i]), STRETCH)
        if size >= CHUNK:
            yield held
            held, size = [], 0
    if held:
        yield held


# ---------------------------------------------------------------------------
# Blocks of texts and shards of words
# ---------------------------------------------------------------------------


def packed(x: np.ndarray) -> bytes:
    """An integer array as compressed bytes behind its length."""
    return len(x).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(x.tobytes(), asbytes=True)


def unpacked(value: pa.Scalar, dtype) -> np.ndarray:
    raw = value.as_buffer()
    n = int.from_bytes(raw[:8].to_pybytes(), "little")
    return np.frombuffer(pa.Codec("zstd").decompress(raw[8:], n * np.dtype(dtype).itemsize), dtype)


def packed_rows(x: np.ndarray) -> bytes:
    """Rows of numbers not below 0: the sum of each in 32 bits, its parts in 16."""
    total = x.sum(axis=1)
    share = x / np.where(total == 0, 1, total)[:, None]
    return total.astype(np.float32).tobytes() + share.astype(np.float16).tobytes()


def unpacked_rows(value: pa.Scalar) -> np.ndarray:
    """The rows; their sums are those that were sent."""
    raw = value.as_py()
    n = len(raw) // (4 + 2 * STATES)
    total, share = np.frombuffer(raw, np.float32, n), np.frombuffer(raw, np.float16, n * STATES, 4 * n).reshape(n, STATES).astype(np.float32)
    return share * (total / np.maximum(share.sum(axis=1), 1e-30))[:, None]


def coded_words(text: pa.Array) -> Tuple[np.ndarray, np.ndarray, pa.Array]:
    """(code of each word, offsets by row, distinct words as an Arrow array)."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(text).cast(pa.large_string()))
    offsets = lists.offsets.to_numpy().astype(np.int64)
    coded = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
    codes, words = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
    offsets = offsets - offsets[0]
    none = pc.index(words, pa.scalar("", words.type)).as_py()
    if none is not None and none >= 0:
        keep = codes != none
        offsets, codes = np.concatenate([[0], np.cumsum(keep)])[offsets], codes[keep]
    return codes, offsets, words


def class_of(words: List[bytes]) -> np.ndarray:
    """Class of each word: its last two bytes, or its only one."""
    return np.array([w[-2] << 8 | w[-1] if len(w) > 1 else 65_536 + w[0] for w in words], np.int64).reshape(-1)


BLOCKS = "kind int, block long, shard int, doc_id long, held_out boolean, n long, a binary, b binary"
#: Kinds of rows: a text (a: its codes, compressed), a block's words of one shard (a: the words, b: their counts
#: in learning texts), and a block's own row (a: shard of each code, b: class of each code).
TEXT, WORDS, BLOCK = 0, 1, 2


def blocks(rows: DataFrame, shards: int) -> str:
    """Writes the texts in blocks, see the kinds above; the table's folder."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, known, counts, tokens = TaskContext.get().partitionId() << 32, {}, [], 0
        pack = pa.Codec("zstd", 1)

        def batch(kind: int, **columns) -> pa.RecordBatch:
            size = len(next(iter(columns.values())))
            full = {"kind": pa.array(np.full(size, kind, np.int32)), "block": pa.array(np.full(size, number, np.int64))}
            types = {"shard": pa.int32(), "doc_id": pa.int64(), "held_out": pa.bool_(), "n": pa.int64(), "a": pa.binary(), "b": pa.binary()}
            return pa.RecordBatch.from_pydict(full | {c: pa.array(columns[c], t) if c in columns else pa.nulls(size, t) for c, t in types.items()})

        def closed() -> Iterator[pa.RecordBatch]:
            words, n = list(known), np.zeros(len(known), np.int64)
            for codes, c in counts:
                n[codes] += c
            shard = np.fromiter((xxhash.xxh64_intdigest(w) % shards for w in words), np.int32, len(words))
            yield batch(BLOCK, a=[packed(shard)], b=[packed(class_of(words).astype(np.int32))])
            order = np.argsort(shard, kind="stable")
            edges = np.searchsorted(shard[order], np.arange(shards + 1))
            for p in np.flatnonzero(np.diff(edges)):
                own = order[edges[p] : edges[p + 1]]  # in order of their codes
                yield batch(WORDS, shard=[int(p)], a=[packed(np.frombuffer(b"\n".join([words[i] for i in own]), np.uint8))], b=[packed(n[own])])

        for b in slices(batches):
            codes, offsets, words = coded_words(b.column("text"))
            # Codes of the block: a word keeps the place where it was first seen.
            # (The empty string at the ends of texts is in the list, but no word.)
            own = np.fromiter((known.setdefault(w, len(known)) if w else -1 for w in words.cast(pa.large_binary()).to_pylist()), np.int64, len(words))
            learns = ~b.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
            c = np.bincount(codes[np.repeat(learns, np.diff(offsets))], minlength=len(words))
            counts.append((own[own >= 0], c[own >= 0]))
            text = own[codes].astype("<u4")
            yield batch(
                TEXT, doc_id=b.column("doc_id").to_pylist(), held_out=b.column("held_out").to_pylist(), n=np.diff(offsets) + 1,
                a=[pack.compress(text[i:j].tobytes(), asbytes=True) for i, j in zip(offsets, offsets[1:])],
            )
            tokens += len(codes)
            if tokens >= BLOCK_TOKENS:
                yield from closed()
                number, known, counts, tokens = number + 1, {}, [], 0
        if counts:
            yield from closed()

    path = shared_path(rows.sparkSession, "blocks")
    rows.mapInArrow(encode, BLOCKS).write.partitionBy("kind").parquet(path)
    return path


SHARDS = "shard int, block long, at binary, c binary, types long, tokens long, own_mass long, rare array<struct<k:int,s:long>>"


def shards_of(table: DataFrame) -> DataFrame:
    """For each shard and block: the row (-1: none) and learning count of the block's words; and one
    row per shard (block -1) with the counts of its own words and its totals."""

    def merge(group: pa.Table) -> pa.Table:
        lists = [unpacked(x, np.uint8).tobytes().split(b"\n") for x in group.column("a")]
        sizes = np.array([len(x) for x in lists])
        coded = pa.array([w for x in lists for w in x], pa.large_binary()).dictionary_encode()
        code = coded.indices.to_numpy(zero_copy_only=False)
        c = np.bincount(code, np.concatenate([unpacked(x, np.int64) for x in group.column("b")]), len(coded.dictionary)).astype(np.int64)
        own = c >= OWN
        at = np.where(own, np.cumsum(own) - 1, -1).astype(np.int32)
        ends = np.append(0, np.cumsum(sizes))
        rare = np.flatnonzero((c > 0) & ~own)
        k = class_of(coded.dictionary.take(pa.array(rare)).to_pylist())
        used, where = np.unique(k, return_inverse=True)
        mass = np.bincount(where, c[rare] + 1, len(used)).astype(np.int64)
        shard, n = group.column("shard")[0].as_py(), len(lists)
        return pa.table(
            {
                "shard": pa.array([shard] * (n + 1), pa.int32()), "block": pa.array([*group.column("block").to_pylist(), -1], pa.int64()),
                "at": pa.array([*(packed(at[code[i:j]]) for i, j in zip(ends, ends[1:])), None], pa.binary()),
                "c": pa.array([*(packed(c[code[i:j]]) for i, j in zip(ends, ends[1:])), packed(c[own])], pa.binary()),
                "types": pa.array([0] * n + [int((c > 0).sum())], pa.int64()), "tokens": pa.array([0] * n + [int(c.sum())], pa.int64()),
                "own_mass": pa.array([0] * n + [int((c[own] + 1).sum())], pa.int64()),
                "rare": pa.array([[]] * n + [[{"k": int(x), "s": int(y)} for x, y in zip(used, mass)]], pa.list_(pa.struct([("k", pa.int32()), ("s", pa.int64())]))),
            }
        )

    own = table.filter(F.col("kind") == WORDS).select("shard", "block", "a", "b")
    return own.groupBy("shard").applyInArrow(merge, SHARDS)


@dataclass
class Totals:
    """What every task knows, whatever the vocabulary: totals, class masses and the small parts of the model."""

    tokens: int  # N
    types: int  # V
    ends: int
    mass: float  # of all words, classes and the end
    others: np.ndarray  # by class: sum of (c + 1) over its words, + 1
    start: np.ndarray
    move: np.ndarray
    classes: np.ndarray  # expected counts by class, and of the end in the last row
    states: np.ndarray  # expected counts of each state, over all symbols

    def emit(self, counts: np.ndarray, share: np.ndarray) -> np.ndarray:
        """State emissions of symbols with these expected counts and unigram shares."""
        return (counts + SMOOTH * share[:, None]) / (self.states + SMOOTH)

    def class_emit(self) -> np.ndarray:
        return self.emit(self.classes, np.append(self.others, self.ends + 1.0) / self.mass)


STATE = "shard int, counts binary, sums array<double>"


def _state(shard: int, counts: np.ndarray) -> pa.Table:
    return pa.table({"shard": pa.array([shard], pa.int32()), "counts": pa.array([counts.astype(np.float32).tobytes()], pa.binary()), "sums": pa.array([counts.sum(axis=0).tolist()], pa.list_(pa.float64()))})


def first_counts(shards: DataFrame) -> DataFrame:
    """Each shard's words with their counts bent by chance in each state."""

    def bend(group: pa.Table) -> pa.Table:
        shard = group.column("shard")[0].as_py()
        c = unpacked(group.column("c")[0], np.int64)
        return _state(shard, c[:, None] / STATES * np.exp(np.random.default_rng([6, shard]).standard_normal((len(c), STATES))))

    return shards.filter("block = -1").select("shard", "c").groupBy("shard").applyInArrow(bend, STATE)


def emissions(shards: DataFrame, state: DataFrame, given, with_counts: bool = False) -> DataFrame:
    """(block, shard, own, emit, c): which of the block's words have rows, and these rows."""

    def send(left: pa.Table, right: pa.Table) -> pa.Table:
        t: Totals = given.value
        out: List[tuple] = []
        if right.num_rows:
            counts = np.frombuffer(right.column("counts")[0].as_py(), np.float32).reshape(-1, STATES)
            rows = list(zip(left.column("block").to_pylist(), left.column("at"), left.column("c")))
            own_c = next(unpacked(c, np.int64) for b, _, c in rows if b == -1)
            emit = t.emit(counts, (own_c + 1) / t.mass).astype(np.float32)
            for block, at, c in rows:
                if block >= 0:
                    at = unpacked(at, np.int32)
                    own = np.flatnonzero(at >= 0)
                    out.append((block, packed(own.astype(np.int32)), packed_rows(emit[at[own]]), c.as_py() if with_counts else None))
        shard = left.column("shard")[0].as_py() if left.num_rows else 0
        cols = list(zip(*out)) or [(), (), (), ()]
        return pa.table({"block": pa.array(cols[0], pa.int64()), "shard": pa.array([shard] * len(out), pa.int32()), "own": pa.array(cols[1], pa.binary()), "emit": pa.array(cols[2], pa.binary()), "c": pa.array(cols[3], pa.binary())})

    left = shards.select("shard", "block", "at", "c")
    return left.groupBy("shard").cogroup(state.select("shard", "counts").groupBy("shard")).applyInArrow(send, "block long, shard int, own binary, emit binary, c binary")


class BlockModel:
    """A block's own emissions, put together from its shards' rows and the classes."""

    def __init__(self, t: Totals, left: pa.Table, right: pa.Table, dtype):
        kind = left.column("kind").to_numpy()
        (i,) = np.flatnonzero(kind == BLOCK)
        self.shard, self.klass = unpacked(left.column("a")[int(i)], np.int32), unpacked(left.column("b")[int(i)], np.int32)
        m = len(self.shard)
        by_class = t.class_emit().astype(dtype)
        emit = np.empty((m + 1, STATES), dtype)
        emit[:m], emit[m] = by_class[self.klass], by_class[-1]
        self.own, self.count = np.zeros(m, bool), np.zeros(m, np.int64)
        order = np.argsort(self.shard, kind="stable")
        edges = np.searchsorted(self.shard[order], np.arange(self.shard.max(initial=0) + 2))
        self.parts = []  # (shard, codes of its words that have rows)
        for shard, own, rows, c in zip(right.column("shard").to_pylist(), right.column("own"), right.column("emit"), right.column("c")):
            codes = order[edges[shard] : edges[shard + 1]]
            mine = codes[unpacked(own, np.int32)]
            emit[mine] = unpacked_rows(rows)
            self.own[mine] = True
            self.parts.append((shard, mine))
            if c.is_valid:
                self.count[codes] = unpacked(c, np.int64)
        self.model = Model(t.start.astype(dtype), t.move.astype(dtype), emit)
        end, pack = np.array([m], np.uint32), pa.Codec("zstd")
        self.texts = left.filter(pa.array(kind == TEXT))
        sizes = [4 * (n - 1) for n in self.texts.column("n").to_pylist()]
        self.sequences = [np.concatenate([np.frombuffer(pack.decompress(x.as_buffer(), n), "<u4"), end]) for x, n in zip(self.texts.column("a"), sizes)]


NAMES = [f"c{k}" for k in range(STATES)]
EXPECTED = "part int, block long, at int, sums binary, " + ", ".join(f"{c} double" for c in NAMES)


def expectations(table: DataFrame, sent: DataFrame, given) -> DataFrame:
    """One E step: a binary row of expected counts for each block and shard, and rows (part -1) for
    classes and the end, starts, transitions and the likelihood, numbered in this order."""

    def expect(left: pa.Table, right: pa.Table) -> pa.Table:
        t: Totals = given.value
        if not (left.num_rows and (left.column("kind").to_numpy() == TEXT).any()):
            return pa.schema([("part", pa.int32()), ("block", pa.int64()), ("at", pa.int32()), ("sums", pa.binary()), *[(c, pa.float64()) for c in NAMES]]).empty_table()
        own = BlockModel(t, left, right, np.float32)
        emit, move, start, likelihood = np.zeros(own.model.emit.shape, order="F"), np.zeros((STATES, STATES)), np.zeros(STATES), 0.0
        for group in grouped(own.sequences):
            likelihood += own.model.expected([own.sequences[i] for i in group], emit, move, start)
        small = np.zeros((CLASSES + 1, STATES))
        rest = np.flatnonzero(~own.own)
        for k in range(STATES):
            small[:CLASSES, k] = np.bincount(own.klass[rest], emit[rest, k], CLASSES)
        small[CLASSES] = emit[-1]
        small = np.concatenate([small, start[None], move, np.full((1, STATES), likelihood)])
        used = np.flatnonzero(small.any(axis=1))
        block, n = left.column("block")[0].as_py(), len(own.parts)
        big = [packed_rows(emit[mine]) for _, mine in own.parts]
        columns = {
            "part": pa.array([p for p, _ in own.parts] + [-1] * len(used), pa.int32()), "block": pa.array([block] * (n + len(used)), pa.int64()),
            "at": pa.array([None] * n + used.tolist(), pa.int32()), "sums": pa.array(big + [None] * len(used), pa.binary()),
        }
        return pa.table(columns | {c: pa.array([None] * n + small[used, k].tolist(), pa.float64()) for k, c in enumerate(NAMES)})

    learns = table.filter((F.col("kind") == BLOCK) | ((F.col("kind") == TEXT) & ~F.col("held_out"))).select("kind", "block", "n", "a", "b")
    return learns.groupBy("block").cogroup(sent.groupBy("block")).applyInArrow(expect, EXPECTED)


def added_up(shards: DataFrame, expected: DataFrame) -> DataFrame:
    """One M step of the shards: the sums of their words' expected counts."""

    def add(left: pa.Table, right: pa.Table) -> pa.Table:
        places, size = {}, 0
        for block, at, c in zip(left.column("block").to_pylist(), left.column("at"), left.column("c")):
            if block == -1:
                size = len(unpacked(c, np.int64))
            else:
                at = unpacked(at, np.int32)
                places[block] = at[at >= 0]
        counts = np.zeros((size, STATES))
        for block, sums in zip(right.column("block").to_pylist(), right.column("sums")):
            counts[places[block]] += unpacked_rows(sums)
        return _state(left.column("shard")[0].as_py(), counts)

    left = shards.select("shard", "block", "at", F.when(F.col("block") == -1, F.col("c")).alias("c"))
    right = expected.filter("part >= 0").select(F.col("part").alias("shard"), "block", "sums")
    return left.groupBy("shard").cogroup(right.groupBy("shard")).applyInArrow(add, STATE)


class Kept:
    """A table in the shared folder that is removed when the next one takes its place."""

    def __init__(self, df: DataFrame, tag: str):
        self.path = shared_path(df.sparkSession, tag)
        df.write.parquet(self.path)
        self.table = df.sparkSession.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        discard(self.table.sparkSession, self.path)


def _state_sums(state: DataFrame) -> np.ndarray:
    return np.array([x or 0.0 for x in state.agg(*[F.sum(F.get("sums", F.lit(k))) for k in range(STATES)]).first()])


def trained(table: DataFrame, shards: DataFrame, t: Totals, rounds: int, gain: float) -> Tuple[Kept, Totals, List[float]]:
    """(shards' counts, the small parts, log10 likelihood a learning token before each round)."""
    spark = table.sparkSession
    rng = np.random.default_rng(6)
    mass = np.append(t.others, t.ends + 1.0)
    t.classes = mass[:, None] / STATES * np.exp(rng.standard_normal((CLASSES + 1, STATES)))
    # States tend to stay.
    t.move = np.full((STATES, STATES), 0.1 / (STATES - 1)) + (0.9 - 0.1 / (STATES - 1)) * np.eye(STATES)
    t.start = np.full(STATES, 1 / STATES)
    state = Kept(first_counts(shards), "state")
    t.states = _state_sums(state.table) + t.classes.sum(axis=0)
    history: List[float] = []
    for _ in range(rounds):
        given = spark.sparkContext.broadcast(t)
        found = Kept(expectations(table, emissions(shards, state.table, given), given), "expected")
        small = np.zeros((CLASSES + 1 + 1 + STATES + 1, STATES))
        sums = found.table.filter("part = -1").groupBy("at").agg(*[F.sum(c).alias(c) for c in NAMES]).toArrow()  # a row for each class at most
        small[sums["at"].to_numpy()] = np.column_stack([sums[c].to_numpy() for c in NAMES])
        before, state = state, Kept(added_up(shards, found.table), "state")
        before.drop()
        found.drop()
        given.unpersist()
        classes, start, move, likelihood = small[: CLASSES + 1], small[CLASSES + 1] + 0.01, small[CLASSES + 2 : -1] + 0.01, small[-1, 0] / t.tokens
        t = Totals(t.tokens, t.types, t.ends, t.mass, t.others, start / start.sum(), move / move.sum(axis=1, keepdims=True), classes, _state_sums(state.table) + classes.sum(axis=0))
        history.append(likelihood)
        if len(history) > 1 and history[-1] - history[-2] < gain:
            break
    return state, t, history


def scored(table: DataFrame, sent: DataFrame, given) -> DataFrame:
    """doc_id, held_out, n, known, base, score of every text."""

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        t: Totals = given.value
        own = BlockModel(t, left, right, np.float64)
        total, c = float(t.tokens + t.types + 1), own.count
        base = np.append(np.log10((c + 1) / total), np.log10((t.ends + 1) / total))
        inside = np.append(np.where(own.own, 0.0, np.log10((c + 1) / t.others[own.klass])), 0.0)  # of a rare word in its class
        known = np.append(c > 0, t.ends > 0)
        hmm = np.zeros(len(own.sequences))
        for group in grouped(own.sequences):
            hmm[group] = own.model.log10([own.sequences[i] for i in group])
        add = lambda x: pa.array([x[q].sum() for q in own.sequences])
        likelihood = pa.array(hmm + np.array([inside[q].sum() for q in own.sequences]) if t.ends else np.zeros(len(hmm)))
        return pa.table({"doc_id": own.texts.column("doc_id"), "held_out": own.texts.column("held_out"), "n": own.texts.column("n"), "known": add(known.astype(np.int64)), "base": add(base), "score": likelihood})

    rows = table.filter(F.col("kind").isin(TEXT, BLOCK)).select("kind", "block", "doc_id", "held_out", "n", "a", "b")
    return rows.groupBy("block").cogroup(sent.groupBy("block")).applyInArrow(score, SCORES)


def _session(spark: SparkSession) -> SparkSession:
    """A session of this operator's own with the caller's widths, in which a query's shuffle files go when it ends."""
    own = spark.newSession()
    for key in ("spark.sql.shuffle.partitions", "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.session.timeZone"):
        own.conf.set(key, spark.conf.get(key))
    own.conf.set(CLEANUP, "true")
    return own


SCORES = "doc_id long, held_out boolean, n long, known long, base double, score double"


def lm_scores(docs: DataFrame, rounds: int = 8, gain: float = 0.002, held_out_fold: int = 2, folds: int = 7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    rows = texts(docs, id_col, text_col).withColumn("held_out", fold_of("doc_id", folds) == held_out_fold)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    encoded = blocks(rows.select("doc_id", "text", "held_out"), max(1, -(-size // SHARD_BYTES)))
    table = _session(docs.sparkSession).read.schema(BLOCKS).parquet(encoded)
    ends = table.filter((F.col("kind") == TEXT) & ~F.col("held_out")).count()
    words = Kept(shards_of(table), "shards")
    shards = words.table
    n = shards.agg(F.sum("tokens"), F.sum("types"), F.sum("own_mass")).first()
    others = np.ones(CLASSES)
    for k, s in shards.filter("block = -1").select(F.explode("rare").alias("x")).groupBy("x.k").agg(F.sum("x.s")).collect():
        others[k] += s
    tokens, types = (n[0] or 0) + ends, (n[1] or 0) + (ends > 0)
    none = np.zeros(0)
    t = Totals(tokens, types, ends, float((n[2] or 0) + others.sum() + ends + 1), others, none, none, none, none)
    state, t, _ = trained(table, shards, t, rounds if ends else 0, gain)
    given = docs.sparkSession.sparkContext.broadcast(t)
    path = shared_path(docs.sparkSession, "scores")
    scored(table, emissions(shards, state.table, given, with_counts=True), given).write.parquet(path)
    state.drop()
    words.drop()
    discard(docs.sparkSession, encoded)
    return docs.sparkSession.read.schema(SCORES).parquet(path).select(
        "doc_id", "held_out", F.col("n").alias("n_tokens"), F.col("known").alias("n_known"), F.lit(t.tokens).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"), "score",
    )
