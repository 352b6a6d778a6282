"""Operator 11 against the definition, and its defined cases."""

import itertools
import re
from collections import Counter, defaultdict

from tidewater.llm import filter_audit

LONG = " ".join(f"w{i}" for i in range(60_000))
ROWS = [
    (1, None, "en", "a"), (2, "", "en", "a"), (2, "", "en", "a"), (3, " ".join(f"x{i}" for i in range(60)), "en", "a"),
    (4, " ".join(f"x{i}" for i in range(60)), "en", None), (4, " ".join(f"x{i}" for i in range(60)), "en", "b"),
    (None, " ".join(f"x{i}" for i in range(60)), "en", "a"), (5, "A " * 55, "en", "b"), (6, "# " + "a " * 60, "en", "b"), (7, LONG, "en", ""),
    (8, LONG, "de", "b"), (9, "\x0b\x1cx é 50% off", None, "b"), (None, None, None, None),
]
LABELS = [(1, 1, 0), (4, 1, 1), (4, 0, None), (8, None, 1), (9, 1, 1), (None, 1, 1), (99, 1, 1)]


def fails(text):
    w = [x for x in re.split("[ \t-\r]+", text) if x]
    caps = len(re.findall("[A-Z]", text))
    return "".join(f for f, on in zip("ABCD", (len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * caps > 5 * len(text), re.search("[#$%&*|]", text))) if on)


def brute(rows, labels):
    first = defaultdict(list)
    for i, t, *_ in rows:
        if i is not None:
            first[t or ""].append(i)
    good = {i for i, q, _ in labels if i is not None and q == 1}
    bad = {i for i, _, t in labels if i is not None and t == 1}
    docs = [(s or "", fails(t or "") + ("E" if i is not None and min(first[t or ""]) < i else ""), i in good, i in bad) for i, t, _, s in rows]
    out, share = {}, Counter()
    for part in {d[0] for d in docs}:
        for order in itertools.permutations("ABCDE"):
            left = [d for d in docs if d[0] == part]
            all_ = left
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                out[part, "".join(order), step] = (
                    len(left), len(gone), sum(f in d[1] for d in all_) - len(gone), sum(d[1] == f for d in all_), sum(d[2] for d in gone), sum(d[3] for d in gone),
                )
                share[part, f] += len(gone)
    return {k: (*v, share[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_audit_equals_the_definition(sp, table_of):
    labels = sp.createDataFrame([(*r, "x") for r in LABELS], "doc_id long, quality int, toxic int, source string")
    got = filter_audit.filter_audit(table_of(ROWS), labels).collect()
    assert {(r.part, r.filter_order, r.step): tuple(r[3:]) for r in got} == brute(ROWS, LABELS)
    assert len(got) == 3 * 120 * 5


def test_audit_of_an_empty_table(sp, table_of):
    labels = sp.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.filter_audit(table_of([]), labels).collect() == []


def test_intervals_cover_every_order_once():
    """A mask is removed exactly once in every order; redundant failures make up the rest."""
    for filters in ("AB", "ABCD"):
        orders = ["".join(p) for p in itertools.permutations(filters)]
        first, again = Counter(), Counter()
        for mask, step, is_first, lo, hi in filter_audit.intervals(filters):
            assert 0 <= lo < hi <= len(orders)
            for rank in range(lo, hi):
                assert mask >> filters.index(orders[rank][step - 1]) & 1
                (first if is_first else again)[mask, rank] += 1
        for mask in range(1, 1 << len(filters)):
            for rank in range(len(orders)):
                assert first[mask, rank] == 1 and again[mask, rank] == mask.bit_count() - 1
