"""Operator 12 against brute force over every window, and its defined cases."""

import random

import numpy as np
import pytest

from tidewater.llm import substring_fm
from tidewater.llm.fm_index import FMIndex


def brute(rows, length):
    least = {}
    docs = [(i, (t or "").encode().split()) for i, t, *_ in rows]
    for i, w in docs:
        for j in range(len(w) - length + 1) if i is not None else ():
            key = tuple(w[j : j + length])
            least[key] = min(least.get(key, i), i)
    out = []
    for i, w in docs:
        gone = set()
        for j in range(len(w) - length + 1) if i is not None else ():
            if least[tuple(w[j : j + length])] < i:
                gone.update(range(j, j + length))
        out.append((i, len(w), len(gone), b" ".join(x for j, x in enumerate(w) if j not in gone).decode()))
    return sorted(out, key=str)


def rows_of(seed, length):
    rng = random.Random(seed)
    text = lambda n: [f"w{rng.randrange(300)}" for _ in range(n)]
    passage, rows = text(length + 11), []
    for i in range(120):
        w = text(rng.randint(0, 4 * length))
        if i % 3 == 0:  # a passage in many documents, in different surroundings
            at = rng.randint(0, len(w))
            w[at:at] = passage[rng.randrange(4) :]
        if i % 7 == 0 and rows:
            w = w + rng.choice(rows)[1].split()
        rows.append((rng.randrange(1000), rng.choice([" ", "\n", " \t "]).join(w), "en", "s"))
    rows += [rows[3]] * 4 + [(None, rows[3][1], None, None), (rows[3][0], rows[5][1], None, None)]
    rows += [(1, None, None, None), (2, "", None, None), (3, "a " * 5 * length, None, None), (4, "a " * 9 * length + "b", None, None), (5, "x y \x1c", "", "")]
    rows += [(2000 + i, " ".join(passage), "en", "s") for i in range(30)]
    return rows


@pytest.mark.parametrize("seed, length", [(1, 10), (2, 50)])
def test_repeats_equal_brute_force(table_of, seed, length):
    rows = rows_of(seed, length)
    got = substring_fm.repeated_windows_removed(table_of(rows), length)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, length)


def test_hot_minimisers_are_dealt_by_windows(table_of):
    """A limit of two segments a minimiser and shards of 100 words change nothing."""
    rows = rows_of(3, 10)
    got = substring_fm.repeated_windows_removed(table_of(rows), 10, shard_words=100, limit=2)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, 10)


def test_very_long_texts(table_of):
    long = " ".join(f"t{i * i % 20_011}" for i in range(20_000))
    rows = [(2, long, "en", "s"), (1, " ".join(long.split()[300:9_000]), "en", "s"), (3, long, "en", "s")]
    got = substring_fm.repeated_windows_removed(table_of(rows), 50)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, 50)


def test_repeats_inside_the_smallest_document(table_of):
    """A segment that its smallest document holds many times, and in two rows of that id, loses its windows at every place."""
    rng = random.Random(5)
    text = lambda n, k: [f"{k}{rng.randrange(10_000)}" for _ in range(n)]
    block, filler = text(14, "b"), text(9, "f")
    cycle = (block + filler) * 8
    rows = [(7, " ".join(["x", *block, "y"]), "en", "s"), (9, " ".join(cycle), "en", "s"), (9, " ".join(["z"] + cycle[:60]), "en", "s"), (11, " ".join(cycle[5:90]), "en", "s")]
    rows += [(20, " ".join(text(6, "q") * 7), "en", "s"), (21, " ".join(["a"] + ["a", "b"] * 40), "en", "s"), (15, " ".join(["b", "a"] * 9 + ["c"]), "en", "s")]
    for kw in ({}, {"shard_words": 100, "limit": 1}):
        got = substring_fm.repeated_windows_removed(table_of(rows), 10, **kw)
        assert sorted(map(tuple, got.collect()), key=str) == brute(rows, 10)


def test_empty_table(table_of):
    assert substring_fm.repeated_windows_removed(table_of([])).collect() == []
    assert [tuple(r) for r in substring_fm.repeated_windows_removed(table_of([(None, None, None, None)])).collect()] == [(None, 0, 0, "")]


def test_matching_statistics_equal_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(40):
        lengths = rng.integers(1, 30, rng.integers(1, 8))
        parts = [rng.integers(1, rng.integers(2, 5), n) for n in lengths]
        owners = rng.integers(0, 4, len(parts))
        codes = np.concatenate(parts)
        want = []
        for s, o in zip(parts, owners):
            others = [t for t, p in zip(parts, owners) if p < o]
            for i in range(len(s)):
                n = 0
                while i + n < len(s) and any((t[j : j + n + 1] == s[i : i + n + 1]).all() for t in others for j in range(len(t) - n)):
                    n += 1
                want.append(n)
        assert FMIndex(codes, lengths, owners, 64).matching_statistics(codes, lengths, owners).tolist() == want
