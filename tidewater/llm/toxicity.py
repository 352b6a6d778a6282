"""Operator 3, toxicity: subsequence string-kernel support vector machine with
Nystroem landmarks.

The kernel of two strings sums, over all subsequences of three characters they
share, decay^(span in one + span in the other), gaps allowed, normalised by the
strings' own kernels. Inserted characters ("id.io.t", "i d i o t") only stretch
spans, so such forms stay close to the plain word.

A sentence is a bag of windows: its words without the symbols around them (up
to 24 characters, longer ones as overlapping windows of 24), words with symbols
inside also without those, and its runs of one- and two-character words read as one. A text is judged by its
WORST different windows with the largest margins: one word that resembles an
insult, however often it is repeated, is less than several.

Training, on at most ``max_rows`` labelled documents (a documented bound):
every distinct sentence of them carries its document's label; windows are
counted by Spark in distinct sentences of either label, so copies of a document
count once. All windows with a significant excess in toxic sentences are the
witnesses (positive examples; the most significant are the Nystroem landmarks);
windows of clean
sentences are the negative ones, those nearest to the witnesses first. A linear
support vector machine is fitted in the landmarks' space, and a logistic
function of the learning documents' worst margins, with no negative weight,
turns margins into probabilities.

The decision function is a sum over landmarks of kernels with them, and so one
weight per subsequence of three characters: scoring a window adds the weights
of its subsequences, and each distinct window is scored once per worker.

Defined cases: a null text counts as empty; margins end at NONE, which also
stands for each window that a text lacks; every input row gets one row; without toxic or clean learning
rows the score is the share of toxic labels (0 without any); texts are never
cut; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from itertools import combinations
from typing import Dict, Iterator, List, Sequence, Tuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WorkerCache, fold_of, slices, split_words, texts
from .labels import learning_rows

DECAY = 0.6
LETTERS = 64  # 26 letters, 10 digits, the rest shared by all other characters
WIDTH, STEP = 24, 12
#: Least z of a witness's excess in toxic sentences.
SIGNIFICANT = 2.5
WORST = 3
KNOTS, RIDGE = np.arange(-1.0, 3.0, 0.5), 0.1
NONE = -1.0  # least margin: where the squared hinge of a negative example ends
PARTS = 24  # of the learning documents' windows
_TRIPLES: Dict[int, Tuple[np.ndarray, np.ndarray]] = {}


def codes_of(window: str) -> bytes:
    out = bytearray()
    for c in window.lower():
        o = ord(c)
        out.append(o - 97 if 97 <= o <= 122 else 26 + o - 48 if 48 <= o <= 57 else 36 + o % 28)
    return bytes(out)


def triples(length: int) -> Tuple[np.ndarray, np.ndarray]:
    """Positions of all subsequences of three characters, and decay^span of each."""
    if length not in _TRIPLES:
        at = np.array(list(combinations(range(length), 3)), np.int64).reshape(-1, 3)
        _TRIPLES[length] = at, DECAY ** (at[:, 2] - at[:, 0] + 1.0)
    return _TRIPLES[length]


def by_length(windows: Sequence[str]) -> Iterator[Tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Groups of equal length: (numbers of the windows, subsequence codes, their weights)."""
    coded = [codes_of(w) for w in windows]
    length = np.fromiter(map(len, coded), np.int64, len(coded))
    for n in np.unique(length[length >= 3]):
        at, weight = triples(int(n))
        which = np.flatnonzero(length == n)
        for part in np.array_split(which, max(1, len(which) * len(at) // 2_000_000)):
            chars = np.frombuffer(b"".join([coded[i] for i in part]), np.uint8).reshape(-1, n).astype(np.int64)
            yield part, (chars[:, at[:, 0]] * LETTERS + chars[:, at[:, 1]]) * LETTERS + chars[:, at[:, 2]], weight


def self_kernel(codes: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Kernel of each string with itself: equal subsequences summed, then squared."""
    order = np.argsort(codes, axis=1)
    ordered, w = np.take_along_axis(codes, order, 1), weight[order]
    total = np.cumsum(w, axis=1)
    last = np.ones(ordered.shape, bool)
    last[:, :-1] = ordered[:, 1:] != ordered[:, :-1]
    out = np.zeros(len(codes))
    row, col = np.nonzero(last)
    ends = total[row, col]
    first = np.concatenate([[True], row[1:] != row[:-1]])
    sums = ends - np.where(first, 0.0, np.concatenate([[0.0], ends[:-1]]))
    np.add.at(out, row, sums * sums)
    return out


def profiles(windows: Sequence[str]) -> Tuple[np.ndarray, np.ndarray]:
    """Landmarks' normalised subsequence vectors: (row of each subsequence, rows x landmarks).

    Row 0 stands for all subsequences that no landmark has.
    """
    groups = list(by_length(windows))
    known = np.unique(np.concatenate([codes.ravel() for _, codes, _ in groups]))
    row_of = np.zeros(LETTERS**3, np.int32)
    row_of[known] = np.arange(1, len(known) + 1)
    out = np.zeros((len(known) + 1, len(windows)), np.float32)
    for part, codes, weight in groups:
        norm = np.sqrt(self_kernel(codes, weight))
        for i, c, k in zip(part, codes, norm):
            np.add.at(out[:, i], row_of[c], weight / k)
    return row_of, out


def kernels(windows: Sequence[str], landmarks: Tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Normalised kernels (windows x landmarks); 0 below three characters."""
    row_of, vectors = landmarks
    out = np.zeros((len(windows), vectors.shape[1]))
    for part, codes, weight in by_length(windows):
        norm = np.sqrt(self_kernel(codes, weight))
        for i, rows, k in zip(part, row_of[codes], norm):
            some = rows > 0
            out[i] = weight[some] @ vectors[rows[some]] / k
    return out


def margins(windows: Sequence[str], weight_of: np.ndarray, bias: float) -> np.ndarray:
    out = np.full(len(windows), bias)
    for part, codes, weight in by_length(windows):
        out[part] += (weight_of[codes] @ weight) / np.sqrt(self_kernel(codes, weight))
    return out


def cut(word: str) -> List[str]:
    return [word] if len(word) <= WIDTH else [word[i : i + WIDTH] for i in range(0, len(word) - WIDTH + STEP, STEP)]


def readings(word: str) -> List[str]:
    """Windows of a word: as it stands and, with symbols inside, also without them."""
    plain = INSIDE.sub("", word)
    return [w for x in ([word] if plain == word else [word, plain]) for w in cut(x) if len(w) >= 3]


SHORT_RUN = re.compile(r"(?:(?<=\s)|\A)\S{1,2}(?:\s+\S{1,2}){2,}(?=\s|\Z)")
#: Characters that are white space to Python, in Arrow's syntax, whose own classes know ASCII only.
SPACES = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
#: Matches every text in which SHORT_RUN can match.
MAY_RUN = rf"(?:^|[{SPACES}])[^{SPACES}]{{1,2}}(?:[{SPACES}]+[^{SPACES}]{{1,2}}){{2}}(?:[{SPACES}]|$)"


INSIDE = re.compile(r"[\W_]+")
AROUND = re.compile(r"\A[\W_]+|[\W_]+\Z")


def short_runs(text: str) -> List[str]:
    """Runs of three or more one- and two-character words, lower-cased."""
    return [r.group().lower() for r in SHORT_RUN.finditer(text)]


def strip(word: str) -> str:
    return AROUND.sub("", word).lower()


def windows_of(sentence: str) -> List[str]:
    words = [w for x in sentence.split() for w in readings(strip(x))]
    return words + [w for r in short_runs(sentence) for w in cut("".join(r.split())) if len(w) >= 3]


def window_counts(rows: DataFrame) -> DataFrame:
    """(window, toxic, clean): distinct sentences of either label that contain the window."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            sentence, window, label = [], [], []
            for text, y in zip(b.column("text").to_pylist(), b.column("label").to_pylist()):
                for s in re.split(r"[.!?\n]+\s", text):
                    for w in set(windows_of(s)):
                        sentence.append(hash_of(s))
                        window.append(w)
                        label.append(y)
            yield pa.RecordBatch.from_pydict({"sentence": pa.array(sentence, pa.int64()), "window": pa.array(window, pa.string()), "label": pa.array(label, pa.int32())})

    distinct = rows.mapInArrow(explode, "sentence long, window string, label int").distinct()
    return distinct.groupBy("window").agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean"))


def hash_of(s: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(s.strip()) - (1 << 63)


def svm(x: np.ndarray, y: np.ndarray, wanted: np.ndarray, weight: np.ndarray, c: float, epochs: int = 400) -> Tuple[np.ndarray, float]:
    """Squared-hinge linear support vector machine by Nesterov's gradient method;
    each example has its wanted margin."""
    x = np.hstack([x, np.ones((len(x), 1))])
    limit = 1 + 2 * c * np.linalg.norm(x * np.sqrt(weight)[:, None], 2) ** 2
    w = v = np.zeros(x.shape[1])
    for t in range(epochs):
        slack = np.maximum(0, wanted - y * (x @ v))
        grad = np.concatenate([v[:-1], [0.0]]) - 2 * c * x.T @ (weight * slack * y)
        new = v - grad / limit
        v, w = new + t / (t + 3) * (new - w), new
    return w[:-1], float(w[-1])


class Model:
    """Weights of subsequences, bias, and the logistic function's slopes and shift."""

    def __init__(self, weight_of, bias, slope, shift, constant=None):
        self.weight_of, self.bias, self.slope, self.shift, self.constant = weight_of, bias, slope, shift, constant
        self.cache = None

    def text_margins(self, text: pa.Array) -> np.ndarray:
        """(texts x WORST) largest margins of different windows of each text, falling."""
        codes, offsets, words = split_words(text)
        if self.cache is None:
            self.cache = WorkerCache(None, 500_000)
        of_word = np.array(self.look([strip(w) for w in words]), np.float64)
        row = np.repeat(np.arange(len(text)), np.diff(offsets))
        margin = of_word[codes]
        above = margin > NONE
        out = self.worst(row[above], margin[above], len(text))
        spread = pc.match_substring_regex(text, MAY_RUN).to_numpy(zero_copy_only=False)
        for i in np.flatnonzero(spread):
            runs = ["".join(r.split()) for r in short_runs(text[int(i)].as_py())]
            if runs:
                out[i] = (sorted({*out[i], *self.look(runs)}, reverse=True) + [NONE] * WORST)[:WORST]
        self.cache.trim()
        return out

    @staticmethod
    def worst(row: np.ndarray, margin: np.ndarray, rows: int) -> np.ndarray:
        order = np.lexsort((-margin, row))
        row, margin = row[order], margin[order]
        other = np.ones(len(row), bool)
        other[1:] = (row[1:] != row[:-1]) | (margin[1:] != margin[:-1])
        row, margin = row[other], margin[other]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        top = rank < WORST
        out = np.full((rows, WORST), NONE)
        out[row[top], rank[top]] = margin[top]
        return out

    def look(self, words: List[str]) -> List[float]:
        missing = [w for w in dict.fromkeys(words) if w not in self.cache]
        parts = [(w, p) for w in missing for p in readings(w)]
        for w in missing:
            self.cache[w] = NONE
        for (w, _), m in zip(parts, margins([p for _, p in parts], self.weight_of, self.bias)):
            self.cache[w] = max(self.cache[w], float(m))
        return [self.cache[w] for w in words]

    def scores(self, text: pa.Array) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(text), self.constant)
        return 1 / (1 + np.exp(-np.clip(ramps(self.text_margins(text)) @ self.slope + self.shift, -30, 30)))

    def __getstate__(self):
        return {**self.__dict__, "cache": None}


def ramps(m: np.ndarray) -> np.ndarray:
    """For each margin, how far it has climbed each step between knots, 0 to 1."""
    return np.clip((m[:, :, None] - KNOTS) / (KNOTS[1] - KNOTS[0]), 0, 1).reshape(len(m), -1)


def logistic(m: np.ndarray, y: np.ndarray) -> Tuple[np.ndarray, float]:
    """Slopes and shift of P(1 | margins), rising in each margin by steps: damped Newton
    steps with a little ridge; steps whose slope comes out negative are left out."""
    steps = ramps(m)
    kept = np.flatnonzero(steps.any(axis=0))
    slope = np.zeros(steps.shape[1])
    while True:
        x, w = np.column_stack([steps[:, kept], np.ones(len(m))]), np.zeros(len(kept) + 1)
        ridge = RIDGE * np.append(np.ones(len(kept)), 1e-3)
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            h = x.T @ (x * (p * (1 - p))[:, None]) + np.diag(ridge)
            step = np.linalg.solve(h, x.T @ (y - p) - ridge * w)
            w = w + step * min(1.0, 2.0 / max(1e-9, float(np.abs(step).max())))
            if np.abs(step).max() < 1e-6:
                break
        if (w[:-1] >= 0).all():
            slope[kept] = w[:-1]
            return slope, float(w[-1])
        kept = kept[w[:-1] >= 0]


def train(rows: DataFrame, landmarks: int = 192, negatives: int = 6_000) -> Model:
    """``rows``: saved (doc_id, text, label). The driver gets all significant windows
    of these rows (positive examples; those of largest z are the ``landmarks``),
    at most ``negatives`` others and WORST margins per learning row."""
    n1, n0 = (rows.agg(F.sum("label"), F.sum(1 - F.col("label"))).first() or (0, 0))[:2]
    if not n1 or not n0:
        return Model(None, 0.0, 1.0, 0.0, constant=float(n1 or 0) / max(1, (n1 or 0) + (n0 or 0)))
    # The sample is bounded, and so are its windows: few partitions, so few top-k lists reach the driver.
    counts = window_counts(rows).coalesce(PARTS).persist()
    t, c = counts.agg(F.sum("toxic"), F.sum("clean")).first()
    excess = F.log((F.col("toxic") + 0.5) / F.lit(float(t))) - F.log((F.col("clean") + 0.5) / F.lit(float(c)))
    scored = counts.withColumn("z", excess / F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5)))
    found = scored.filter((F.col("z") >= SIGNIFICANT) & (excess > math.log(20))).select("window", "toxic", "z").collect()
    found.sort(key=lambda r: (-r.z, r.window))
    witnesses = [r.window for r in found]
    if not witnesses:
        counts.unpersist()
        return Model(None, 0.0, 1.0, 0.0, constant=float(n1) / (n1 + n0))
    marks = rows.sparkSession.sparkContext.broadcast(profiles(witnesses[:landmarks]))

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            near = kernels(b.column("window").to_pylist(), marks.value).max(axis=1) if b.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_pydict({"window": b.column("window"), "near": pa.array(near)})

    clean = scored.filter((F.col("clean") > 0) & (excess < math.log(2))).select("window").mapInArrow(nearest, "window string, near double")
    hard = [r.window for r in clean.orderBy(F.desc("near"), "window").limit(negatives // 2).select("window").collect()]
    common = scored.filter((F.col("clean") > 0) & (excess < math.log(2))).orderBy(F.desc("clean"), "window").limit(negatives // 2)
    others = [r.window for r in common.select("window").collect()]
    counts.unpersist()
    examples = [*dict.fromkeys(hard + others)]
    row_of, vectors = marks.value
    own = vectors.T @ vectors
    value, vector = np.linalg.eigh(own.astype(np.float64))
    root = vector / np.sqrt(np.maximum(value, 1e-3))  # kernels -> landmark space
    x = np.vstack([kernels(witnesses, marks.value), kernels(examples, marks.value)]) @ root
    y = np.array([1.0] * len(witnesses) + [-1.0] * len(examples))
    seen_in = np.array([r.toxic for r in found], float)
    weight = np.concatenate([seen_in / seen_in.sum() * len(examples) / 4, np.ones(len(examples))])
    # The more toxic sentences have a witness, the surer it is: a larger margin is asked of it.
    wanted = np.concatenate([np.maximum(1.0, np.log2(1 + seen_in) / 3), np.ones(len(examples))])
    w, bias = svm(x, y, wanted, weight / weight.sum() * len(y), c=1.0)
    model = Model((vectors @ (root @ w))[row_of], bias, 1.0, 0.0)
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def worst(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            m = sent.value.text_margins(b.column("text"))
            yield pa.RecordBatch.from_arrays([*map(pa.array, m.T.copy()), b.column("label")], [*names, "label"])

    names = [f"m{i}" for i in range(WORST)]
    seen = rows.select("text", "label").mapInArrow(worst, ", ".join(f"{c} double" for c in names) + ", label int").toArrow()
    model.slope, model.shift = logistic(np.column_stack([seen[c].to_numpy() for c in names]), seen["label"].to_numpy().astype(float))
    return model


def fitted(docs: DataFrame, labels: DataFrame, label: str, max_rows: int, id_col: str, text_col: str):
    """The model learnt from the labelled documents, sent to the tasks."""
    rows = texts(docs, id_col, text_col)
    return docs.sparkSession.sparkContext.broadcast(train(learning_rows(rows, labels, label, max_rows)))


def toxicity_scores(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    threshold: float = 0.5,
    max_rows: int = 12_000,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, held_out, score (probability of label 1), predicted."""
    model = fitted(docs, labels, label, max_rows, id_col, text_col)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            p = model.value.scores(b.column("text"))
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "held_out": b.column("held_out"), "score": pa.array(p), "predicted": pa.array((p >= threshold).astype(np.int32))})

    held = texts(docs, id_col, text_col).withColumn("held_out", fold_of("doc_id", 5) == 0)
    return held.mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int")


def drop_toxic(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    threshold: float = 0.5,
    max_rows: int = 12_000,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` without the documents predicted toxic, filtered where they lie."""
    model = fitted(docs, labels, label, max_rows, id_col, text_col)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text_col):
            p = model.value.scores(pc.fill_null(b.column(text_col), ""))
            yield b.filter(pa.array(p < threshold))

    return docs.mapInArrow(clean, docs.schema)
