"""Operator 10, token counts: byte-pair merging with a heap and a linked list.

Each word starts as a linked list of its bytes' symbols. A heap holds the
adjacent pairs that have a merge rank; the lowest rank (leftmost on ties) is
popped, stale entries are skipped, the pair becomes one symbol, and the pairs
with its new neighbours are pushed. The count is the number of initial symbols
minus the merges made; ids are never emitted. O(n log n) for a word of n bytes,
so a very long word is no special case.

The vocabulary file (merge ranks) is read by each worker from ``path``. Words
repeat, so a worker keeps a bounded cache of their counts.

Defined cases: null and empty texts have 0 tokens; special strings count as one
token each, as the library does by default; one row per input row, repeated
rows included; other columns are ignored.
"""

from __future__ import annotations

import heapq
import json
from functools import lru_cache
from typing import Dict, Iterator, Tuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from .common import WorkerCache, slices, texts
from .tokens import BYTE_PATTERN, byte_alphabet, odd_spaces, space_pieces


class MergeCounter:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["model"]["type"] != "BPE":
            raise ValueError("a byte-level BPE file is expected")
        vocab = spec["model"]["vocab"]
        self.byte_id = [vocab[c] for c in byte_alphabet()]
        #: (left id, right id) -> (rank, id of the merged symbol)
        self.merges: Dict[Tuple[int, int], Tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[vocab[a], vocab[b]] = (rank, vocab[a + b])
        specials = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.specials = regex.compile("|".join(map(regex.escape, specials))) if specials else None
        self.word = WorkerCache(lambda w: self.count_word(w.encode()))
        self.piece = WorkerCache(lambda p: sum([self.word[w] for w in BYTE_PATTERN.findall(p)]))

    def count_word(self, word: bytes) -> int:
        symbols = [self.byte_id[b] for b in word]
        n = len(symbols)
        if n < 2:
            return n
        merges = self.merges
        following, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            m = merges.get((symbols[i], symbols[i + 1]))
            if m:
                heap.append((m[0], i, m[1], symbols[i], symbols[i + 1]))
        heapq.heapify(heap)
        count = n
        while heap:
            _, i, merged, left, right = heapq.heappop(heap)
            j = following[i]
            if symbols[i] != left or j >= n or symbols[j] != right:
                continue  # one of the two has been merged meanwhile
            symbols[i], symbols[j] = merged, -1
            after = following[i] = following[j]
            count -= 1
            if after < n:
                before[after] = i
                m = merges.get((merged, symbols[after]))
                if m:
                    heapq.heappush(heap, (m[0], i, m[1], merged, symbols[after]))
            previous = before[i]
            if previous >= 0:
                m = merges.get((symbols[previous], merged))
                if m:
                    heapq.heappush(heap, (m[0], previous, m[1], symbols[previous], merged))
        return count

    def count(self, text: str) -> int:
        """One text, word by word."""
        parts = self.specials.split(text) if self.specials else [text]
        return len(parts) - 1 + sum(self.word[w] for p in parts for w in BYTE_PATTERN.findall(p))

    def count_batch(self, text: pa.Array) -> np.ndarray:
        apart = odd_spaces(text)
        if self.specials:
            apart |= pc.match_substring_regex(text, self.specials.pattern).to_numpy(zero_copy_only=False)
        codes, offsets, pieces = space_pieces(pc.if_else(pa.array(apart), "", text))
        of_piece = np.fromiter((self.piece[p] if p else 0 for p in pieces), np.int64, len(pieces))
        totals = np.concatenate([[0], np.cumsum(of_piece[codes])])[offsets]
        n = np.diff(totals)
        for i in np.flatnonzero(apart):
            n[i] = self.count(text[int(i)].as_py())
        self.word.trim()
        self.piece.trim()
        return n


@lru_cache(maxsize=2)
def counter(path: str) -> MergeCounter:
    return MergeCounter(path)


def token_counts(docs: DataFrame, path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(path)
        for b in slices(batches):
            n = c.count_batch(b.column("text"))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": b.column("doc_id"),
                    "n_bytes": pc.binary_length(b.column("text")).cast(pa.int64()),
                    "n_tokens": pa.array(n),
                    "over_limit": pa.array(n > limit),
                }
            )

    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    return texts(docs, id_col, text_col).mapInArrow(count, schema)
