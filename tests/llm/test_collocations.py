"""Operator 13 against brute force, with bins and routing made small enough to matter."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidewater.llm import collocations

SPLIT, BLANK = "[.,;:!?\n-\r]", "[ \t]+"


def brute(rows, least, top):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang, _ in rows:
        low = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split(SPLIT, low):
            w = [x for x in re.split(BLANK, piece) if x]
            n[lang or "und"] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f[lang or "und"][tuple(w[i : i + k])] += 1
    out = []
    for lang, c in f.items():
        found = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        inside = Counter()
        for p, a in found.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i : i + k]] = max(inside[p[i : i + k]], a)
        rank = []
        for p, a in found.items():
            if p in inside and 100 * inside[p] >= 80 * a:
                continue
            score, k = min((2_000_000 * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
            rank.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(rank)[:top], 1)]
    return sorted(out)


def rows_of(seed=1):
    rng = random.Random(seed)
    words = ["the", "of", "cat", "Été", "日本", "x\x0by"[0], "a", "b", "c d", "E"]
    rows = []
    for i in range(300):
        t = [rng.choice(words[: rng.randint(2, len(words))]) for _ in range(rng.randint(0, 40))]
        rows.append((i, "".join(w + rng.choice([" ", " ", "  ", "\t", ", ", ".", "\n", "; "]) for w in t), rng.choice(["en", "de", None]), "s"))
    hot = "The common phrase goes on and on"
    rows += [(1000 + i, f"{hot} word{i % 40} {hot}! the common {i}", "en", "s") for i in range(200)]
    rows += [(5, None, "en", None), (None, "", None, None), (None, hot, "en", "s"), (7, "z" * 20_000 + " of the " * 3_000, "fr", "s"), (7, "  .,;\t ", "es", "s")]
    return rows


def test_collocations_equal_brute_force(table_of):
    rows = rows_of()
    got = collocations.collocations(table_of(rows), least=5, top=60)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 5, 60)


def test_frequent_beginnings_are_split_over_bins(table_of):
    """Bins of 500 suffixes: hot pairs go by three words, hot triples by four; nothing changes."""
    rows = rows_of(2)
    docs = table_of(rows)
    seen = collocations.survey(docs.selectExpr("coalesce(lang, 'und') AS lang", "coalesce(text, '') AS text"), 64)
    tokens = seen.filter("kind = 0").selectExpr("sum(n)").first()[0]
    heavy = collocations.heavy_prefixes(seen, tokens, -(-tokens // 500), 64)
    assert len(heavy[2]) and len(heavy[3])
    got = collocations.collocations(docs, least=5, top=60, bin_size=500, heavy=64)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 5, 60)


def test_collocations_of_an_empty_table(table_of):
    assert collocations.collocations(table_of([])).collect() == []
    assert collocations.collocations(table_of([(1, None, None, None)])).collect() == []


@pytest.mark.parametrize("small", [1, 50])
def test_quicksort_counts_every_beginning(small):
    rng = np.random.default_rng(3)
    columns = rng.integers(0, 6, (4, 3_000))
    columns[3][columns[2] == 2] = -1
    weight = rng.integers(1, 4, 3_000)
    want = Counter()
    for i in range(3_000):
        for d in range(1, 5):
            p = tuple(columns[:d, i])
            if p[-1] >= 0:
                want[p] += int(weight[i])
    for least in ([40] * 4, [1, 1, 40, 40]):
        got = {tuple(columns[:d, p]): int(n) for at, d, counts in collocations.multikey_quicksort(columns, weight, least, small) for p, n in zip(at, counts)}
        assert got == {p: n for p, n in want.items() if n >= least[len(p) - 1]}
