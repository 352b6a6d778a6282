"""Operators against brute force, the libraries, and the defined edge cases."""

import itertools
import math
import re
import uuid
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewater.llm import (
    contamination, exact_dedup, graph, lm_hmm, ngram_join, packing, quality_ftrl, token_counts, tokens, toxicity, training_order, url_filter,
)
from tidewater.llm.common import ship
from tidewater.llm.queries import URL_RULES

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, set string, key string, at long, label int"
LONG = " ".join(f"word{i % 977}x{i}" for i in range(30_000))
PASSAGE = "the quick brown fox jumps over the lazy dog near the old river bank today"
TEXTS = [
    (1, None), (2, ""), (3, "   \n\t "), (4, PASSAGE), (5, PASSAGE.upper()), (6, PASSAGE + " again"), (6, PASSAGE + " again"),
    (7, "short one"), (8, "x" * 5_000), (9, LONG), (10, LONG), (None, PASSAGE), (11, "a  b c <|endoftext|> d"), (12, "id.iot é ñ 日本"),
]


@pytest.fixture(scope="module")
def sp(spark):
    ship(spark)
    return spark


@pytest.fixture()
def odd(sp):
    """Nulls, empty and long texts, repeated rows, ties, and columns with names the operators use."""
    return sp.createDataFrame([(i, t, None, "s", None, "x", None, 0, 1) for i, t in TEXTS], SCHEMA)


@pytest.fixture()
def none(sp):
    return sp.createDataFrame([], SCHEMA)


@pytest.fixture()
def labels(sp):
    rows = [(i, i % 2, i % 3 % 2, "x") for i in range(1, 13)] + [(None, 1, 1, "x"), (4, None, None, "x")]
    return sp.createDataFrame(rows, "doc_id long, quality int, toxic int, text string")


def docs_of(sp):
    return sp.read.parquet(f"{SF}/documents.parquet")


def words(t):
    return [w for w in re.split("[ \t-\r]+", (t or "").translate({c: c + 32 for c in range(65, 91)})) if w]


def test_token_ids_and_counts_equal_the_library():
    odd = [t for _, t in TEXTS if t is not None] + ["  a", "a\n\nb  c", "ÀÉ'S don't ſ ΑΣ é", " \x1c!\x1d! ", "a\u0085b", "!" * 300, "<|startoftext|>Hi<|endoftext|>"]
    import pyarrow.parquet as pq

    text = pa.array(odd + pq.read_table(f"{SF}/documents.parquet")["text"].to_pylist())
    for path in (WORD, BYTE):
        e, lib = tokens.encoder(path), Tokenizer.from_file(path)
        want = [x.ids for x in lib.encode_batch(text.to_pylist(), add_special_tokens=False)]
        ids, ends = e.encode_batch(text)
        assert [ids[a:z].tolist() for a, z in zip(ends, ends[1:])] == want
        assert e.count_batch(text).tolist() == list(map(len, want))
    assert token_counts.counter(BYTE).count_batch(text).tolist() == list(map(len, want))


def test_token_counts_edges(odd, none):
    got = token_counts.token_counts(odd, BYTE).collect()
    assert len(got) == len(TEXTS)
    lib = Tokenizer.from_file(BYTE)
    for r, (i, t) in zip(got, TEXTS):
        assert (r.doc_id, r.n_bytes) == (i, len((t or "").encode()))
        assert r.n_tokens == len(lib.encode(t or "", add_special_tokens=False).ids) and r.over_limit == (r.n_tokens > 512)
    assert token_counts.token_counts(none, BYTE).collect() == []


def test_exact_dedup_edges(odd, none):
    for k in (1, 1000):
        rows = exact_dedup.exact_duplicates(odd, k=k).collect()
        assert len(rows) == len(TEXTS)
        by = {r.doc_id: r for r in rows}
        assert (by[1].keep_id, by[1].group_size, by[2].kept) == (2, 2, True)
        assert by[4].keep_id == by[5].keep_id == by[None].keep_id == 5 and by[5].group_size == 3
        assert by[9].keep_id == 10 and by[6].group_size == 2 and by[6].kept
    assert sorted(r.doc_id or 0 for r in exact_dedup.drop_exact_duplicates(odd).collect()) == [2, 3, 5, 6, 7, 8, 10, 11, 12]
    assert exact_dedup.exact_duplicates(none).collect() == []
    assert exact_dedup.drop_exact_duplicates(odd).columns == odd.columns


def test_misra_gries_keeps_what_is_frequent():
    stream = ["a"] * 60 + [f"x{i}" for i in range(50)] + ["b"] * 45
    counts = {}
    for part in (stream[::2], stream[1::2]):
        for w, n in Counter(part).items():
            counts[w] = counts.get(w, 0) + n
        counts = exact_dedup.misra_gries(counts, 4)
    assert {"a", "b"} <= set(counts) and len(counts) <= 4


def brute_groups(rows, threshold=0.8):
    sets = {}
    for i, t in rows:
        w = words(t)
        sets[i] = frozenset(tuple(w[j : j + 5]) for j in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    link, root = defaultdict(int), {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and len(x & y) >= threshold * len(x | y):
            link[a] += 1
            link[b] += 1
            p, q = find(a), find(b)
            root[max(p, q)] = min(p, q)
    return {i: (find(i), link[i]) for i in sets}


def test_ngram_join_equals_brute_force(sp):
    docs = docs_of(sp)
    want = brute_groups([(r.doc_id, r.text) for r in docs.collect()])
    got = {r.doc_id: (r.class_id, r.n_links) for r in ngram_join.near_duplicates(docs).collect()}
    assert got == want


def test_ngram_join_blocks_and_large_groups(sp, monkeypatch):
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(90):
        w = list(base)
        w[(i * 7) % 200] = f"edit{i}"
        rows.append((i, " ".join(w)))
    monkeypatch.setattr(ngram_join, "BLOCK_MEMBERS", 20)
    got = {r.doc_id: (r.class_id, r.n_links) for r in ngram_join.near_duplicates(sp.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_groups(rows)


def test_ngram_join_edges(odd, none):
    by = {r.doc_id: r for r in ngram_join.near_duplicates(odd).collect()}
    assert by[1].class_id == 1 and by[2].n_links == 0 and by[3].class_id == 3
    assert by[4].class_id == by[5].class_id == by[6].class_id == by[None].class_id == 4
    assert by[9].class_id == by[10].class_id == 9 and by[9].n_links == 1
    assert by[4].n_links == 4  # 5, the one without an id, and 6 twice
    assert ngram_join.near_duplicates(none).collect() == []
    assert ngram_join.drop_near_duplicates(odd).columns == odd.columns


def test_pruning_bound_and_exact_similarity():
    for k, m in ngram_join.least_matches(0.8, 1e-9):
        below = sum(math.comb(k + 1, i) * 0.8**i * 0.2 ** (k + 1 - i) for i in range(m))
        assert below < 1e-9 <= below + math.comb(k + 1, m) * 0.8**m * 0.2 ** (k + 1 - m)
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 400, 200).astype(np.uint64)) for _ in range(30)]
    a, b = np.triu_indices(30, 1)
    want = [len(np.intersect1d(sets[i], sets[j])) / len(np.union1d(sets[i], sets[j])) for i, j in zip(a, b)]
    assert np.allclose(ngram_join.jaccard(sets, a, b), want)
    assert np.allclose(ngram_join.jaccard(sets, a[:5], b[:5]), want[:5])


def test_components(sp):
    edges = [(i, i + 1) for i in range(40)] + [(100, 102), (101, 102), (103, 103)]
    got = {r.node: r.root for r in graph.components(sp.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}


def test_contamination_sizes_and_edges(sp, odd, none, monkeypatch):
    items = sp.createDataFrame([(1, PASSAGE), (2, "SHORT one"), (3, ""), (4, None), (5, PASSAGE + " and then many more words follow after it"), (None, "x"), (6, LONG)], "item_id long, text string")
    want = {(i, 1) for i in (4, 5, 6)} | {(7, 2), (9, 6), (10, 6)}
    for limit in (contamination.MAX_VALUES, 1):  # the second: every pair of classes by shared shingles
        monkeypatch.setattr(contamination, "MAX_VALUES", limit)
        got = contamination.contained_items(odd, items)
        assert {(r.doc_id, r.item_id) for r in got.collect()} == want
    assert {(r.doc_id, r.item_id) for r in contamination.contained_items(odd, items, broadcast_rows=0).collect()} == want
    assert contamination.contained_items(none, items).collect() == [] and contamination.contained_items(odd, items.limit(0)).collect() == []
    left = contamination.drop_contaminated(odd, items)
    assert left.columns == odd.columns and {r.doc_id for r in left.collect()} == {1, 2, 3, 8, 11, 12}


def test_packing_gives_every_id_once(sp, odd, none):
    lib = Tokenizer.from_file(WORD)
    pieces = packing.pack(odd, WORD, length=64, with_ids=True).collect()
    assert sum(r.length for r in pieces) == sum(len(lib.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in TEXTS)
    for r in pieces:
        assert r.offset + r.length <= 64 and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
    for i, t in TEXTS:
        if i not in (6,):
            own = sorted((r for r in pieces if r.doc_id == i), key=lambda r: r.start)
            assert sum((r.ids for r in own), []) == lib.encode(t or "", add_special_tokens=False).ids + [1]
    filled = Counter()
    for r in sorted(pieces, key=lambda r: (r.sequence_id, r.offset)):
        assert filled[r.sequence_id] == r.offset
        filled[r.sequence_id] += r.length
    assert all(n == 64 for s, n in filled.items() if s != max(filled))
    assert packing.pack(none, WORD).collect() == []


def test_hilbert_neighbours():
    cells = np.array(list(itertools.product(range(8), repeat=3)))
    path = cells[np.argsort(packing.hilbert(cells, 3))]
    assert sorted(packing.hilbert(cells, 3)) == list(range(512))
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize("total", [1, 2, 3, 64, 1000])
def test_permutation(total):
    slot = training_order.slot_of(np.arange(total), total, 7)
    assert sorted(slot) == list(range(total))
    assert (training_order.index_of(slot, total, 7) == np.arange(total)).all()


def test_training_order_round_trip(sp, odd, none, tmp_path):
    for path in (WORD, BYTE):
        out = f"{tmp_path}/{uuid.uuid4().hex}"
        m = training_order.materialise(odd.coalesce(1), out, path, length=64, per_shard=100, seed=3)
        rows = training_order.read_slots(sp, out).collect()
        assert [r.slot for r in sorted(rows, key=lambda r: r.slot)] == list(range(m["sequences"]))
        lib, ids = Tokenizer.from_file(path), []
        for r in sorted(rows, key=lambda r: r.sequence):
            assert zlib.crc32(r.ids) == r.ids_crc32 and r.slot == training_order.slot_of(np.array([r.sequence]), m["sequences"], 3)[0]
            ids += np.frombuffer(r.ids, f"<u{m['id_bytes']}")[: r.n_tokens].tolist()
        assert ids == [x for _, t in TEXTS for x in lib.encode(t or "", add_special_tokens=False).ids + [1]]
        resumed = training_order.read_slots(sp, out, 150, 75).collect()
        assert sorted(r.slot for r in resumed) == list(range(150, 225))
    training_order.materialise(none, f"{tmp_path}/none", WORD)
    assert training_order.read_slots(sp, f"{tmp_path}/none").collect() == []


def test_damaged_slots_are_found(sp, odd, tmp_path):
    out = f"{tmp_path}/damaged"
    training_order.materialise(odd.coalesce(1), out, WORD, length=64, per_shard=100, seed=3)
    file = next((tmp_path / "damaged" / "shards").rglob("*.txt"))
    raw = bytearray(file.read_bytes())
    raw[28] ^= 1  # the first id of the first record
    file.write_bytes(raw)
    (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    with pytest.raises(Exception, match="CRC of its header"):
        training_order.read_slots(sp, out).drop("ids").collect()


def test_values_needed_by_the_least_jaccard():
    for c in range(8):
        for k in range(8):
            sizes = [(s, i) for s in range(1 << c, 2 << c) for i in range(1 << k, 2 << k) if s >= math.ceil(0.8 * i)]
            if sizes:
                least = min(math.ceil(0.8 * i) / (s + i - math.ceil(0.8 * i)) for s, i in sizes)
                missed = (1 - least) ** contamination.values_needed(0.8, c, k, 1e-6)
                assert missed <= 1.001e-6, (c, k, least)


def test_quality_edges(odd, none, labels):
    rows = quality_ftrl.quality_scores(odd, labels).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert {r.score for r in quality_ftrl.quality_scores(odd, labels.limit(0)).collect()} == {0.5}
    assert quality_ftrl.quality_scores(none, labels).collect() == []


def test_ftrl_equals_a_plain_version(sp, monkeypatch):
    """The update with dictionaries, and the scores as plain sums over each text's n-grams."""
    q = quality_ftrl
    rng = np.random.default_rng(9)
    z, n = np.zeros(50), np.zeros(50)
    pz, pn = defaultdict(float), defaultdict(float)

    def weight(i):
        if abs(pz[i]) <= q.L1:
            return 0.0
        return (math.copysign(q.L1, pz[i]) - pz[i]) / ((q.BETA + math.sqrt(pn[i])) / q.ALPHA + q.L2)

    for _ in range(200):
        at = rng.choice(50, rng.integers(1, 9), replace=False)
        value, label = rng.random(len(at)), int(rng.integers(2))
        q.ftrl(z, n, at, value, label)
        w = {i: weight(i) for i in at}
        p = 1 / (1 + math.exp(-sum(w[i] * v for i, v in zip(at, value))))
        for i, v in zip(at, value):
            g = (p - label) * v
            sigma = (math.sqrt(pn[i] + g * g) - math.sqrt(pn[i])) / q.ALPHA
            pz[i] += g - sigma * w[i]
            pn[i] += g * g
        assert np.allclose([z[i] for i in at], [pz[i] for i in at]) and np.allclose([n[i] for i in at], [pn[i] for i in at])
    model = rng.standard_normal(q.SIZE + 1)
    monkeypatch.setattr(q, "train", lambda *a: model)
    texts = ["", "One two, THREE three three!", " a  b\ta b\n", "x" * 300, *(t for _, t in TEXTS if t)]
    df = _rows(sp, list(enumerate(texts)))
    for r in q.quality_scores(df, sp.createDataFrame([(1, 1)], "doc_id long, quality int")).collect():
        row, index, value = q.features(pa.array([texts[r.doc_id]]))
        margin = sum(model[i] * v for i, v in zip(index, value))
        assert math.isclose(r.score, 1 / (1 + math.exp(-max(-30, min(30, margin)))), rel_tol=1e-9) and r.predicted == (r.score >= 0.3)
    # Of two labels of an id the majority counts, 1 on a tie.
    from tidewater.llm.labels import learning_rows

    learnt = next(i for i in range(50) if zlib.crc32(str(i).encode()) % 5)
    known = sp.createDataFrame([(learnt, 1), (learnt, 0)], "doc_id long, quality int")
    assert [r.label for r in learning_rows(_rows(sp, [(learnt, "t")]).select("doc_id", "text"), known, "quality", 10).collect()] == [1]


def test_quality_learns(sp):
    sf = "/root/testdata/sf0.01"
    lab = sp.read.parquet(f"{sf}/labels.parquet")
    got = quality_ftrl.quality_scores(sp.read.parquet(f"{sf}/documents.parquet"), lab).join(lab, "doc_id").filter("held_out").toPandas()
    assert (got.predicted == got.quality).mean() > max(got.quality.mean(), 1 - got.quality.mean()) + 0.05


def test_toxicity_edges(odd, none, labels):
    rows = toxicity.toxicity_scores(odd, labels).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in toxicity.toxicity_scores(odd, labels.limit(0)).collect()} == {0.0}
    assert toxicity.toxicity_scores(none, labels).collect() == []
    assert toxicity.drop_toxic(odd, labels).columns == odd.columns


def brute_kernel(s, t):
    def spans(x):
        out = Counter()
        for i, j, k in itertools.combinations(range(len(x)), 3):
            out[x[i] + x[j] + x[k]] += toxicity.DECAY ** (k - i + 1)
        return out

    a, b = spans(s), spans(t)
    dot = lambda x, y: sum(v * y[k] for k, v in x.items())
    return dot(a, b) / math.sqrt(dot(a, a) * dot(b, b))


def test_string_kernel_and_disguised_insults(sp):
    marks = toxicity.profiles(["banana", "idiot"])
    for s in ("banana", "id.iot", "bandana", "i-d-i-o-t"):
        assert np.allclose(toxicity.kernels([s], marks)[0], [brute_kernel(s, "banana"), brute_kernel(s, "idiot")], atol=1e-5)
    rng = np.random.default_rng(2)
    plain = ["".join(rng.choice(list("aerntslu"), 6)) for _ in range(400)]
    rows = []
    for i in range(400):
        w = list(rng.choice(plain, 30))
        if i % 4 == 0:
            w[int(rng.integers(30))] = ("idiot", "moron")[i // 4 % 2]
        rows.append((i, " ".join(w), int(i % 4 == 0)))
    model = toxicity.train(sp.createDataFrame(rows, "doc_id long, text string, label int"))
    clean = " ".join(plain[:20])
    score = model.scores(pa.array([clean, clean + " idiot.", clean + " id.iot", clean + " i d i o t " + clean, clean + " mo-ron", ""]))
    assert score[0] < 0.5 and score[5] < 0.5 and (score[1:5] > 0.5).all()


def test_all_significant_windows_are_examples(sp, monkeypatch):
    rng = np.random.default_rng(3)
    word = lambda letters: "".join(rng.choice(list(letters), 7))
    plain, insults = [word("aerntslu") for _ in range(300)], [word("bcdfgkmopz") for _ in range(8)]
    rows = [(i, " ".join([*rng.choice(plain, 12), insults[i // 5 % 8]] if i % 5 == 0 else rng.choice(plain, 12)), int(i % 5 == 0)) for i in range(400)]
    seen, real = [], toxicity.svm
    monkeypatch.setattr(toxicity, "svm", lambda x, y, *a, **k: seen.append((x.shape[1], int((y > 0).sum()))) or real(x, y, *a, **k))
    toxicity.train(sp.createDataFrame(rows, "doc_id long, text string, label int"), landmarks=3)
    assert seen == [(3, 8)]


def test_runs_of_pairs_are_scored():
    texts = ["words st up id words", "st up id", "words s t u p i d", "st\u00a0up\u2003id", "st\x1cup\x85id", "sté up ïd ok", "st\nup\tid", "some st up words", "", "long words only"]
    found = pa.compute.match_substring_regex(pa.array(texts), toxicity.MAY_RUN).to_pylist()
    assert found == [bool(toxicity.short_runs(t)) for t in texts] == [True] * 7 + [False] * 3
    for c in map(chr, [*range(0xD800), *range(0xE000, 0x11000)]):
        if c.isspace():
            assert pa.compute.match_substring_regex(pa.array([f"ab{c}cd{c}ef"]), toxicity.MAY_RUN)[0].as_py(), hex(ord(c))
    codes, weight = next((c, w) for _, c, w in toxicity.by_length(["stupid"]))
    weight_of = np.zeros(toxicity.LETTERS**3)
    weight_of[codes[0]] = 5.0
    model = toxicity.Model(weight_of, -0.9, np.array([1.0]), 0.0)
    pairs, plain = model.text_margins(pa.array(["words st up id words", "words and words"]))[:, 0]
    assert pairs > 1 > plain


def test_forward_recursion_is_a_distribution():
    rng = np.random.default_rng(5)
    k, s = 3, 4  # symbol 3 ends a text
    m = lm_hmm.Model(rng.dirichlet(np.ones(k)), rng.dirichlet(np.ones(k), k), rng.dirichlet(np.ones(s), k).T)
    seqs = [np.array([*p, 3]) for n in range(4) for p in itertools.product(range(3), repeat=n)]
    got = 10 ** m.log10(seqs)
    states = {}
    for i, (x, p) in enumerate(zip(seqs, got)):
        paths = {z: m.start[z[0]] * np.prod([m.move[a, b] for a, b in zip(z, z[1:])]) * np.prod([m.emit[y, q] for y, q in zip(x, z)]) for z in itertools.product(range(k), repeat=len(x))}
        assert math.isclose(p, sum(paths.values()), rel_tol=1e-9)
        states[i] = {z: w / p for z, w in paths.items()}
    assert got.sum() < 1
    # Expected counts equal the sums over all paths.
    want_emit, want_move, want_start = np.zeros((s, k)), np.zeros((k, k)), np.zeros(k)
    for i, x in enumerate(seqs):
        for z, w in states[i].items():
            want_start[z[0]] += w
            for y, q in zip(x, z):
                want_emit[y, q] += w
            for a, b in zip(z, z[1:]):
                want_move[a, b] += w
    emit, move, start = np.zeros((s, k)), np.zeros((k, k)), np.zeros(k)
    likelihood = m.expected(seqs, emit, move, start)
    assert np.allclose(emit, want_emit) and np.allclose(move, want_move) and np.allclose(start, want_start)
    assert math.isclose(likelihood, np.log10(got).sum())


def test_long_texts_carry_the_forward_variable_over_borders():
    rng = np.random.default_rng(6)
    m = lm_hmm.Model(rng.dirichlet(np.ones(4)), rng.dirichlet(np.ones(4), 4), rng.dirichlet(np.ones(9), 4).T)
    seqs = [rng.integers(0, 9, n) for n in (1, 7, 64, 65, 300, 1000)]
    assert np.allclose(m.log10(seqs, stretch=64), m.log10(seqs, stretch=10_000), rtol=1e-12)
    sums = []
    for stretch in (64, 10_000):
        emit, move, start = np.zeros((9, 4)), np.zeros((4, 4)), np.zeros(4)
        m.expected(seqs, emit, move, start, stretch)
        sums.append((emit, move, start))
        assert np.allclose(emit.sum(axis=1), np.bincount(np.concatenate(seqs), minlength=9)) and math.isclose(start.sum(), len(seqs))
        assert math.isclose(move.sum(), sum(len(q) - 1 for q in seqs))  # no step is lost at a border
    assert all(abs(a - b).max() < 0.05 * b.max() for a, b in zip(*sums))


def test_long_texts_go_side_by_side_as_short_ones(monkeypatch):
    """A step of the recursions costs much the same for a few texts as for a hundred."""
    monkeypatch.setattr(lm_hmm, "CHUNK", 6_400)
    monkeypatch.setattr(lm_hmm, "STRETCH", 64)
    seqs = [np.zeros(n, np.int64) for n in [3] * 50 + [5_000] * 100]
    groups = list(lm_hmm.grouped(seqs))
    assert sorted(i for g in groups for i in g) == list(range(150)) and len(groups) == 2
    assert all(sum(min(len(seqs[i]), 64) for i in g) < 6_400 + 64 for g in groups)


def test_scaling_every_few_steps_equals_scaling_every_step(monkeypatch):
    rng = np.random.default_rng(7)
    k, s = 5, 11
    for least, dtype, near in ((1e-3, np.float64, 1e-9), (1e-12, np.float32, 1e-3)):  # steps that take nearly all away need scaling at once
        emit = (rng.dirichlet(np.ones(s), k).T * np.where(np.arange(s)[:, None] % k == np.arange(k), 1, least)).astype(dtype)
        move = (np.eye(k) * (1 - 5 * least) + least).astype(dtype)
        m = lm_hmm.Model(np.full(k, 1 / k, dtype), move, emit)
        seqs = [rng.integers(0, s, n) for n in (1, 2, 3, 4, 5, 8, 9, 40, 200)]
        out = []
        for every in (lm_hmm.RESCALE, 1):
            real = lm_hmm.Model.forward
            with monkeypatch.context() as p:
                p.setattr(lm_hmm.Model, "forward", lambda self, s, first, n=every: real(self, s, first, n))
                sums = np.zeros((s, k)), np.zeros((k, k)), np.zeros(k)
                out.append((m.log10(seqs, stretch=16), m.expected(seqs, *sums, stretch=16), *sums))
        assert all(np.isfinite(x).all() and np.allclose(x, y, rtol=near, atol=near) for x, y in zip(*out))
        assert np.allclose(out[0][2].sum(axis=1), np.bincount(np.concatenate(seqs), minlength=s), rtol=1e-4)


def _held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def test_language_model(sp, odd, none, monkeypatch):
    docs = docs_of(sp)
    text = {r.doc_id: words(r.text) + [None] for r in docs.collect()}
    c = Counter(w for i, t in text.items() if not _held(i) for w in t)
    n, v = sum(c.values()), len(c)
    monkeypatch.setattr(lm_hmm, "BLOCK_TOKENS", 20_000)  # several blocks and shards
    monkeypatch.setattr(lm_hmm, "SHARD_BYTES", 100_000)
    got = lm_hmm.lm_scores(docs, rounds=3, gain=-1).collect()
    assert len(got) == len(text)
    for r in got:
        t = text[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (_held(r.doc_id), len(t), sum(c[w] > 0 for w in t), n)
        assert math.isclose(r.base_score, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), rel_tol=1e-9)
    assert sum(r.score for r in got if r.held_out) > sum(r.base_score for r in got if r.held_out)
    rows = lm_hmm.lm_scores(odd, rounds=1).collect()
    assert len(rows) == len(TEXTS) and all(r.score < 0 for r in rows) and [r.n_tokens for r in sorted(rows, key=lambda r: r.doc_id or 99)][:2] == [1, 1]
    assert lm_hmm.lm_scores(none).collect() == []
    held = next(i for i in range(99) if _held(i))
    (r,) = lm_hmm.lm_scores(_rows(sp, [(held, "never learnt")])).collect()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (True, 3, 0, 0, 0.0, 0.0)


def test_sharded_rounds_equal_rounds_in_one_place(sp, monkeypatch):
    """Two Baum-Welch rounds over blocks and shards give the scores of a plain recomputation with dictionaries."""
    rng = np.random.default_rng(8)
    rows = [(i, " ".join(rng.choice([f"a{j}" for j in range(12)] + [f"b{j}" for j in range(12)], rng.integers(0, 40)))) for i in range(1, 60)]
    rows += [(None, "rare1 a1 rare2"), (500, "a1 unseen b1")]
    monkeypatch.setattr(lm_hmm, "BLOCK_TOKENS", 150)
    monkeypatch.setattr(lm_hmm, "SHARD_BYTES", 500)
    kept = {}
    real = lm_hmm.trained
    monkeypatch.setattr(lm_hmm, "trained", lambda table, shards, t, *a: kept.update(
        shards=shards.filter("block >= 0").select("shard", "block", "at").collect(), first=lm_hmm.first_counts(shards).collect(), out=(out := real(table, shards, t, *a)), final=out[0].table.collect(),
    ) or kept["out"])
    df = _rows(sp, rows)
    scores = {r.doc_id: r.score for r in lm_hmm.lm_scores(df, rounds=2, gain=-1).collect()}
    k = lm_hmm.STATES
    learn = [(i, t.split()) for i, t in rows if not _held(i)]
    c = Counter(w for _, t in learn for w in t)
    # The first counts of each word, by shard and row; then everything in dictionaries.
    first, shards = {}, -(-sum(len(t) for _, t in rows) // 500)
    import xxhash

    state = {r.shard: np.frombuffer(r.counts, np.float32).reshape(-1, k) for r in kept["first"]}
    own = [w for w in c if c[w] >= lm_hmm.OWN]
    by_shard = defaultdict(list)
    for w in own:
        by_shard[xxhash.xxh64_intdigest(w.encode()) % shards].append(w)
    assert {p: len(x) for p, x in state.items() if len(x)} == {p: len(x) for p, x in by_shard.items()}
    # Every block's words with three occurrences have a row of their shard.
    rows_of = defaultdict(set)
    for row in kept["shards"]:
        rows_of[row.shard].update(lm_hmm.unpacked(pa.scalar(bytes(row["at"])), np.int32).tolist())
    assert all(rows_of[p] - {-1} == set(range(len(w))) for p, w in by_shard.items())
    rest = lambda w: lm_hmm.class_of([w.encode()])[0]
    others = np.ones(lm_hmm.CLASSES)
    for w in c:
        if w not in own:
            others[rest(w)] += c[w] + 1
    ends = len(learn)
    mass = sum(c[w] + 1 for w in own) + others.sum() + ends + 1
    _, t, history = kept["out"]
    assert len(history) == 2 and history[1] > history[0]
    assert math.isclose(t.mass, mass) and (t.others == others).all() and t.tokens == sum(c.values()) + ends
    emit = t.class_emit()
    total = {p: np.frombuffer(x, np.float32).reshape(-1, k) for p, x in ((r.shard, r.counts) for r in kept["final"])}
    everything = sum(x.sum(axis=0) for x in total.values()) + t.classes.sum(axis=0)
    assert math.isclose(everything.sum(), t.tokens, rel_tol=1e-5) and np.allclose(everything, t.states, rtol=1e-5)
    # The emissions of each state are a distribution over own words, classes and the end.
    sums = emit.sum(axis=0)
    for p, words_of in by_shard.items():
        assert math.isclose(total[p].sum(), sum(c[w] for w in words_of), rel_tol=1e-5)
        sums = sums + (total[p].sum(axis=0) + lm_hmm.SMOOTH * sum(c[w] + 1 for w in words_of) / mass) / (t.states + lm_hmm.SMOOTH)
    assert np.allclose(sums, 1, rtol=1e-5)
    assert set(scores) == {i for i, _ in rows} and all(x < 0 for x in scores.values())


def test_packed_values_come_back():
    rng = np.random.default_rng(2)
    for x in (np.zeros(0, np.int32), rng.integers(-1, 9_000, 1_000).astype(np.int32), np.array([1 << 40], np.int64)):
        assert (lm_hmm.unpacked(pa.scalar(lm_hmm.packed(x)), x.dtype) == x).all()
    rows = rng.random((500, lm_hmm.STATES)) ** 9 * 10.0 ** rng.integers(-12, 7, (500, 1))
    rows[3] = 0
    back = lm_hmm.unpacked_rows(pa.scalar(lm_hmm.packed_rows(rows)))
    assert np.allclose(back.sum(axis=1), rows.sum(axis=1), rtol=1e-5)
    share = rows[rows.sum(axis=1) > 0]
    share = share / share.sum(axis=1, keepdims=True)
    got = back[rows.sum(axis=1) > 0]
    assert abs(got / got.sum(axis=1, keepdims=True) - share).max() < 1e-3


def test_rounds_see_all_learning_texts_and_stop_by_gain(sp, monkeypatch):
    docs = sp.createDataFrame([(None, "a b a b")] * 30 + [(None, "c d c d")] * 30, "doc_id long, text string")
    for gain, most in ((-1.0, 4), (10.0, 2)):
        seen, real = [], lm_hmm.expectations
        monkeypatch.setattr(lm_hmm, "expectations", lambda table, *a: seen.append(table.filter((F.col("kind") == 0) & ~F.col("held_out")).count()) or real(table, *a))
        lm_hmm.lm_scores(docs, rounds=4, gain=gain).collect()
        monkeypatch.setattr(lm_hmm, "expectations", real)
        assert seen == [60] * most


def test_lm_hmm_trains_until_it_gains_little_by_default(sp, monkeypatch):
    rng = np.random.default_rng(8)
    docs = _rows(sp, [(i, " ".join(f"{'ab'[j // 4 % 2]}{rng.integers(6)}" for j in range(60))) for i in range(40)])
    seen, real = [], lm_hmm.trained
    monkeypatch.setattr(lm_hmm, "trained", lambda *a: seen.append(out := real(*a)) or out)
    lm_hmm.lm_scores(docs).collect()
    history = seen[0][2]
    assert len(history) == 8 or (len(history) > 3 and history[-1] - history[-2] < 0.002)


def test_nothing_that_grows_with_the_vocabulary_is_broadcast(sp, monkeypatch):
    import pickle

    sizes = []
    real = lm_hmm.trained
    monkeypatch.setattr(lm_hmm, "trained", lambda *a: sizes.append(len(pickle.dumps((out := real(*a))[1]))) or out)
    for n in (200, 4_000):
        lm_hmm.lm_scores(_rows(sp, [(None, " ".join(f"w{i}" for i in range(n)))] * 4), rounds=1).collect()
    assert abs(sizes[0] - sizes[1]) < 64  # a longer number or two


def test_url_rules_and_parts(sp):
    urls = [
        (1, "http://A.Example.org/es/9?x"), (2, "https://example.org/en/12"), (3, "http://x.com/fr/1#a"), (4, "http://x.com/de/1"), (5, None), (6, "nothing"),
        (7, "http://other.net/a"), (8, "http://example.org"), (9, "http://notexample.org/es/1"), (9, "http://notexample.org/es/1"), (None, "ftp://U:1?q/r"), (10, "http://x.com/" + "d/" * 500),
    ]
    pages = sp.createDataFrame([(i, u, "h", "t") for i, u in urls], "page_id long, url string, html string, template string")
    got = {r.page_id: r for r in url_filter.judge_urls(pages, URL_RULES).collect()}
    rule = {i: (r.rule, r.verdict) for i, r in got.items() if r.rule}
    assert rule == {1: ("example.org/es/", "block"), 2: ("example.org/en/1", "block"), 3: ("com/fr/", "allow"), 4: ("com/de/", "block"), 9: ("org/", "allow")}
    assert (got[1].host, got[1].path, got[5].host, got[6].path, got[None].host, got[8].path) == ("a.example.org", "/es/9", "", "", "u:1", "")
    assert url_filter.judge_urls(pages, URL_RULES).count() == len(urls) and got[10].template.count("/") == 500 and got[10].template.endswith("/d" * 499)
    assert url_filter.judge_urls(pages.limit(0), URL_RULES).collect() == []


def test_url_templates_learn_from_labels(sp):
    rows = [(f"h{h}.com", f"/spam/{i}", 1 if i < 20 else None) for h in range(2) for i in range(60)]
    rows += [(f"h{h}.com", f"/news/{i}.html", 0 if i < 20 else None) for h in range(2) for i in range(60)]
    rows += [("h0.com", f"/u/user{i}name/about", 0) for i in range(40)]
    t = url_filter.path_templates(sp.createDataFrame(rows, "host string, path string, label int")).collect()
    by = {(r.host, r.path): r for r in t}
    assert by["h0.com", "/spam/50"].purity > 0.5 > by["h0.com", "/news/50.html"].purity
    assert by["h0.com", "/spam/50"].template == "/spam/*" and by["h0.com", "/u/user3name/about"].template == "/u/*/about"


def brute_templates(rows, z=1.96, w=4.0):
    """The tree walked one segment at a time, with dictionaries."""
    urls = defaultdict(lambda: [0, 0, 0])
    for host, path, label in rows:
        u = urls[host, path]
        u[0] += 1
        u[1] += label is not None
        u[2] += label or 0
    seg = {k: ["*" if re.search(url_filter.IDENTIFIER, s) else s for s in k[1].split("/") if s] for k in urls}

    def smoothed(purity, group):
        sums = defaultdict(lambda: [0, 0])
        for k in purity:
            sums[group(k)][0] += urls[k][1]
            sums[group(k)][1] += urls[k][2]
        return {k: (sums[group(k)][1] + w * p) / (sums[group(k)][0] + w) for k, p in purity.items()}

    def different(h1, n1, h, n):
        p = (h + 0.5) / (n + 1)
        return abs((h1 + p) / (n1 + 1) - (h - h1 + p) / (n - n1 + 1)) / math.sqrt(p * (1 - p) * (1 / (n1 + 1) + 1 / (n - n1 + 1)))

    labelled, blocked = sum(u[1] for u in urls.values()), sum(u[2] for u in urls.values())
    purity = {k: (blocked + 1) / (labelled + 2) for k in urls}
    purity = smoothed(smoothed(purity, lambda k: ".".join(k[0].split(".")[-2:])), lambda k: k[0])
    template, out, d = {k: "" for k in urls}, {}, 0
    while True:
        out.update({k: (template[k], purity[k]) for k in urls if len(seg[k]) == d})
        active = [k for k in urls if len(seg[k]) > d]
        if not active:
            return out
        tree = defaultdict(lambda: defaultdict(lambda: [0, 0, 0, 0]))
        for k in active:
            x = tree[k[0], template[k]][seg[k][d]]
            for i, v in enumerate((*urls[k], urls[k][0] if len(seg[k]) > d + 1 and seg[k][d + 1] == "*" else 0)):
                x[i] += v
        for k in active:
            kids = tree[k[0], template[k]]
            n, lab, blk, nxt = kids[seg[k][d]]
            an, al, ab, ax = map(sum, zip(*kids.values()))
            same_labels, same_next = different(blk, lab, ab, al) < z, different(nxt, n, ax, an) < z
            alike = len(kids) >= 3 and same_labels and same_next
            rare = len(kids) > url_filter.MANY and n < url_filter.FEW * an
            rare = rare and (same_labels or lab < url_filter.TELLING) and (same_next or n < url_filter.TELLING)
            seg[k].append(("*" if rare or alike else seg[k][d]))
        template = {**template, **{k: template[k] + "/" + seg[k].pop() for k in active}}
        purity = smoothed({k: purity[k] for k in active}, lambda k: (k[0], template[k]))
        d += 1


def test_url_templates_equal_a_plain_walk(sp):
    rng = np.random.default_rng(7)
    rows = []
    for h in ("a.x.com", "b.x.com", "y.org", ""):
        for _ in range(250):
            deep = [rng.choice(["news", "shop", "u", "tag", "1234567", f"p{rng.integers(40)}"]) for _ in range(rng.integers(0, 5))]
            shared = ["one", "two", "three", "2024"] * int(rng.integers(0, 2))
            label = [None, None, 0, 1][rng.integers(4)] if deep[:1] != ["shop"] else 1
            rows.append((h, "/" + "/".join(deep[:1] + shared + deep[1:]), label))
    rows += [("deep.net", "/" + "/".join("abcdefghijkl") + "/" + x + f"/{i}", b) for x, b in (("bad", 1), ("good", 0)) for i in range(10)]
    rows += [("z.com", None or "", None), ("z.com", "/", 1), ("z.com", "//a//b", 0)]
    got = {(r.host, r.path): (r.template, r.purity) for r in url_filter.path_templates(sp.createDataFrame(rows, "host string, path string, label int")).collect()}
    want = brute_templates(rows)
    assert got.keys() == want.keys()
    for k, (t, p) in want.items():
        assert got[k][0] == t and math.isclose(got[k][1], p, rel_tol=1e-9), (k, got[k], (t, p))
    # Far below the eighth segment, two branches keep purities of their own.
    assert got["deep.net", "/" + "/".join("abcdefghijkl") + "/bad/3"][1] > 0.5 > got["deep.net", "/" + "/".join("abcdefghijkl") + "/good/3"][1]


def test_labelled_sections_of_a_wide_node_stay_apart(sp):
    words = ["".join(p) for p in itertools.product("abcdefgh", repeat=2)][:60]  # every one below 2 % of the urls
    rows = [("h.com", f"/{w}/page{'xyz'[i % 3]}{'pqrst'[i // 3 % 5]}", int(w == "cd") if i < 10 else None) for w in words for i in range(15)]
    rows += [("h.com", f"/{w}z/pagexp", int(w == "ab")) for w in words]  # one label can't tell
    t = url_filter.path_templates(sp.createDataFrame(rows, "host string, path string, label int")).collect()
    bad = {r.path.split("/")[1] for r in t if r.purity >= 0.5}
    assert bad == {"cd"} and {r.template.split("/")[1] for r in t} == {"*", "cd"}


def test_pipeline_equals_its_stages_by_brute_force(sp):
    import corpus_pipeline as p

    docs = docs_of(sp)
    toxic = {r.doc_id for r in toxicity.toxicity_scores(docs, sp.read.parquet(f"{SF}/labels.parquet")).filter("predicted = 1").collect()}
    rows = {r.doc_id: r.text for r in docs.collect() if r.doc_id not in toxic}
    keep = {}
    for i, t in rows.items():
        k = t.translate({c: c + 32 for c in range(65, 91)})
        keep[k] = max(keep.get(k, i), i)
    rows = {i: rows[i] for i in keep.values()}
    groups = brute_groups(rows.items())
    rows = {i: t for i, t in rows.items() if groups[i][0] == i}
    leaks = []
    for r in sp.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = words(r.text)
        leaks.append({tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))})
    for i, t in list(rows.items()):
        w = words(t)
        own = {tuple(w[j : j + 5]) for j in range(len(w) - 4)}
        if any(len(own & s) >= 0.8 * len(s) for s in leaks):
            del rows[i]
    got = p.run(sp, SF).collect()
    lib = Tokenizer.from_file(WORD)
    total = Counter()
    for r in got:
        total[r.doc_id] += r.length
    assert total == {i: len(lib.encode(t, add_special_tokens=False).ids) + 1 for i, t in rows.items()}


#: One id on two texts, rows without an id, and repeated rows; near copies of each under other ids.
A, B, C, D = (" ".join(f"{x}{i}" for i in range(40)) for x in "abcd")
CLASHES = [(1, A), (1, B), (2, B.upper()), (None, C), (None, C), (7, D), (7, D)]


def _rows(sp, rows):
    return sp.createDataFrame([(i, t, None, "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")


def _left(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_stages_judge_rows_not_ids(sp):
    once = sorted([(1, A), (2, B.upper()), (None, C), (7, D)], key=str)
    for k in (1, 1000):
        assert _left(exact_dedup.drop_exact_duplicates(_rows(sp, CLASHES), k=k)) == once
    near = [(1, A), (1, B), (2, B + " more"), (None, C), (None, C + " more"), (7, D), (7, D), (7, D + " more"), (9, ""), (9, "")]
    left = _left(ngram_join.drop_near_duplicates(_rows(sp, near)))
    # Of C's two rows without an id either may stay, of D's with the same id either.
    assert [i for i, _ in left] == sorted([1, 1, None, 7, 9, 9], key=str) and (1, A) in left and (1, B) in left
    links = {(r.doc_id, r.n_links) for r in ngram_join.near_duplicates(_rows(sp, [(5, A), (5, B), (6, B + " x"), (None, A + " x")])).collect()}
    assert links == {(5, 1), (6, 1), (None, 1)}
    items = sp.createDataFrame([(1, B), (2, C)], "item_id long, text string")
    for limit in (500_000, 0):
        assert _left(contamination.drop_contaminated(_rows(sp, CLASHES), items)) == sorted([(1, A), (7, D), (7, D)], key=str)


def test_pipeline_on_odd_and_empty_documents(sp, tmp_path):
    import corpus_pipeline as p

    for t in ("labels", "benchmark"):
        sp.read.parquet(f"{SF}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    rest = [(r.doc_id, r.text) for r in docs_of(sp).filter("doc_id BETWEEN 100 AND 160").collect()]
    _rows(sp, CLASHES + [(3, None), (4, "")] + rest).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.doc_tokens for r in p.run(sp, str(tmp_path)).collect()}
    lib = Tokenizer.from_file(WORD)
    count = lambda t: len(lib.encode(t, add_special_tokens=False).ids) + 1
    assert got[1] == count(A) and got[2] == count(B.upper()) and got[None] == count(C) and got[7] == count(D)
    assert 3 not in got and got[4] == 1  # equal empty texts: the largest id stays
    _rows(sp, []).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    assert p.run(sp, str(tmp_path)).collect() == []


@pytest.mark.parametrize("key", ["op5_decontamination", "op7_exact_dedup"])
def test_registered_sql_gives_the_same_rows(sp, key):
    import duckdb

    from scripts.check_oracle import digest
    from tidewater.llm import queries

    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(queries.ORACLE[key])
    cols = [d[0] for d in want.description]
    got = queries.QUERIES[key](sp, SF).select(*cols)
    assert digest(cols, list(map(tuple, got.collect()))) == digest(cols, want.fetchall())
