"""Token ids of a public tokenizer for whole texts, with a cache of pieces.

The two ``tokenizers`` files used here split a text into words before any
merge, so a text can be cut where no word crosses and each piece encoded once
per worker:

- word BPE (white space dropped): the pieces are the runs between ASCII white
  space; normalisation, splitting and merging never look across it;
- byte BPE (a single space belongs to the next word): when every space stands
  alone between two other characters, the pieces are the runs between spaces,
  each with its leading space.

Pieces with characters where Python and the library might differ, special
strings and any other kind of tokenizer go to the library whole.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from functools import lru_cache
from typing import Dict, List, Tuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from .common import WorkerCache, ragged, split_words

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Pre-tokenisation pattern of the byte BPE file's ByteLevel step (fixed value).
BYTE_PATTERN = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
#: A space next to white space, white space at an end, or white space beyond ASCII's usual six.
ODD_SPACE = r" [\t-\r ]|[\t-\r] |\A[\t-\r ]|[\t-\r ]\z|[\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: Characters whose lower case and composition are the same everywhere.
PLAIN = re.compile("[\x21-\x7e\xc0-\xd6\xd8-\xf6\xf8-\xff]*\\Z")


def byte_alphabet() -> List[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(kept)]
    return [chr(b) if b in set(kept) else chr(256 + rest.index(b)) for b in range(256)]


def odd_spaces(text: pa.Array) -> np.ndarray:
    """Rows that can't be cut at their spaces for byte BPE."""
    return pc.match_substring_regex(text, ODD_SPACE).to_numpy(zero_copy_only=False)


def space_pieces(text: pa.Array) -> Tuple[np.ndarray, np.ndarray, List[str]]:
    """Pieces of byte-BPE texts without odd spaces: (code of each, offsets by row, distinct pieces).

    Every piece but a text's first has its leading space."""
    lists = pc.split_pattern(text.cast(pa.large_string()), " ")
    offsets = lists.offsets.to_numpy().astype(np.int64)
    coded = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
    offsets = offsets - offsets[0]
    codes = coded.indices.to_numpy(zero_copy_only=False).copy()
    plain = coded.dictionary.to_pylist()
    first, where = np.unique(codes[offsets[:-1]], return_inverse=True)
    codes[offsets[:-1]] = len(plain) + where
    return codes, offsets, [" " + p for p in plain] + [plain[i] for i in first]


class Encoder:
    """``encode_batch(texts)`` gives all ids and the offsets of each text's ids."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.lib = Tokenizer.from_file(path)
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.dtype = np.dtype("<u2" if self.lib.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
        self.vocab_size = self.lib.get_vocab_size(with_added_tokens=True)
        steps = spec["pre_tokenizer"].get("pretokenizers", [spec["pre_tokenizer"]])
        kinds = [s["type"] for s in steps]
        self.table = str.maketrans({chr(b): c for b, c in enumerate(byte_alphabet())})
        self.kind = "other"
        if kinds == ["ByteLevel"] and steps[0]["use_regex"] and not steps[0]["add_prefix_space"] and not spec["normalizer"]:
            self.kind, self.pattern = "byte", BYTE_PATTERN
        elif kinds == ["Split", "ByteLevel"] and steps[0]["behavior"] == "Removed" and steps[0]["invert"]:
            norm = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
            if norm == ["NFC", "Replace", "Lowercase"]:
                self.kind, self.pattern = "word", regex.compile(steps[0]["pattern"]["Regex"])
        self.word = WorkerCache(self._word, 700_000)
        self.piece = WorkerCache(self._piece, 200_000)

    def whole(self, text: str) -> bytes:
        """By the library, in one go."""
        return np.array(self.lib.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _word(self, word: str) -> bytes:
        """One pre-token through the library's model."""
        if not word.isascii() or " " in word or not word.isprintable():
            word = word.encode().decode("latin-1").translate(self.table)
        return array(self.dtype.char, [t.id for t in self.lib.model.tokenize(word)]).tobytes()

    def _piece(self, piece: str) -> bytes:
        if self.kind == "word":
            if not PLAIN.match(piece):
                return self.whole(piece)
            piece = piece.lower()
            if piece.isalpha():
                return self.word[piece]
        return b"".join([self.word[w] for w in self.pattern.findall(piece)])

    def _special(self, text: pa.Array) -> np.ndarray:
        found = np.zeros(len(text), bool)
        for s in self.specials:
            found |= pc.match_substring(text, s).to_numpy(zero_copy_only=False)
        return found

    def _ids(self, piece: str) -> bytes:
        """A piece's ids; plain words, also with a comma or full stop, need no entry of their own."""
        core = piece[self.kind == "byte" and piece[:1] == " " :]
        if core.isascii():
            if core.isalpha():
                return self.word[piece.lower() if self.kind == "word" else piece]
            if core[-1:] in (",", ".") and core[:-1].isalpha():
                return self.word[piece[:-1].lower() if self.kind == "word" else piece[:-1]] + self.word[core[-1]]
        return self.piece[piece]

    def _coded(self, text: pa.Array) -> Tuple[np.ndarray, np.ndarray, List[bytes], Dict[int, np.ndarray]]:
        """(code of each piece, offsets by row, ids of each code, ids of the rows that are done apart)."""
        self.word.trim()
        self.piece.trim()
        if self.kind == "other":
            special = apart = np.ones(len(text), bool)
        else:
            special = self._special(text)
            apart = special | odd_spaces(text) if self.kind == "byte" else special
        done = {}
        for i in map(int, np.flatnonzero(apart)):
            t = text[i].as_py()
            done[i] = np.frombuffer(self.whole(t) if special[i] else b"".join([self.word[w] for w in self.pattern.findall(t)]), self.dtype)
        codes, offsets, pieces = (space_pieces if self.kind == "byte" else split_words)(pc.if_else(pa.array(apart), "", text))
        return codes, offsets, [self._ids(p) for p in pieces], done

    def count_batch(self, text: pa.Array) -> np.ndarray:
        codes, offsets, ids, done = self._coded(text)
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // self.dtype.itemsize
        n = np.diff(np.concatenate([[0], np.cumsum(lengths[codes])])[offsets])
        for i, own in done.items():
            n[i] = len(own)
        return n

    def encode_batch(self, text: pa.Array) -> Tuple[np.ndarray, np.ndarray]:
        codes, offsets, ids, done = self._coded(text)
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // self.dtype.itemsize
        values = np.frombuffer(b"".join(ids), self.dtype)
        n = lengths[codes]
        out = values[ragged((np.cumsum(lengths) - lengths)[codes], n)]
        ends = np.concatenate([[0], np.cumsum(n)])[offsets]
        if done:
            rows = [done[i] if i in done else out[ends[i] : ends[i + 1]] for i in range(len(text))]
            out = np.concatenate(rows)
            ends = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
        return out, ends.astype(np.int64)


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder per worker and file."""
    return Encoder(path)
