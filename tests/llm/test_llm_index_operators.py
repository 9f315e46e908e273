"""Bit-sliced top-k, source divergence and the Merkle manifest against brute
force, with nulls, ties, repeated rows, empty tables and clashing columns."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pytest

from forgestat.llm import bit_sliced, divergence, manifest
from forgestat.llm.transducer import Streamer, Transducer, build

EXTRA = ", slot long, total long, word long, dim int, block long, tree string, n long, score long"
MORE = (1, 2, 3, 4, 5, "x", 6, 7)
DOCS = "doc_id long, text string, lang string, source string, n_chars long" + EXTRA


# --- operator 11 ---------------------------------------------------------------------------

def vectors():
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(9)]) for i in range(0, 300)]
    rows += [(300, [0.0] * 9), (350, [-1.5] * 9), (302, rows[50][1]), (303, rows[50][1])]            # zero, negative, equal
    rows += [(400, None), (450, [0.1] * 8 + [None]), (500, [0.1] * 8 + [math.nan]), (550, [math.inf] * 9), (None, [0.5] * 9)]
    rows += [(600, [0.1, 0.2]), (601, [0.3, -0.4]), (650, []), (651, [])]                            # other lengths
    rows += [(7, rows[7][1]), (100, rows[100][1]), (9, [0.7] * 9)]                                    # repeated rows, one id twice
    rows += [(-50, [0.2] * 9), (700, [500000.0, 500000.0]), (701, [-500000.0, 500000.0])]
    return rows


def best_by_brute_force(rows, k):
    seen = {(i, tuple(v)) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    q = [(i, [math.floor(256 * x) for x in v]) for i, v in sorted(seen)]
    out = []
    for i, a in q:
        if i % 50 == 0:
            found = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), j) for j, b in q if j != i and len(b) == len(a))
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(found[:k])]
    return sorted(out)


def test_op11_is_exact(spark):
    rows = [(*r, *MORE) for r in vectors()]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>" + EXTRA)
    got = sorted(tuple(r) for r in bit_sliced.top_inner_products(df).collect())
    assert got == best_by_brute_force(vectors(), 5)
    assert bit_sliced.top_inner_products(df.limit(0)).collect() == []


def test_op11_blocks_and_slabs(spark, monkeypatch):
    """Many blocks and slabs: ties across blocks go to the smaller id."""
    monkeypatch.setattr(bit_sliced, "BLOCK", 70)
    monkeypatch.setattr(bit_sliced, "SLAB", 3)
    monkeypatch.setattr(bit_sliced, "CELL_BLOCKS", 2)
    rng = random.Random(6)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25]) for _ in range(4)]) for i in range(1000)]
    got = bit_sliced.top_inner_products(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(7), k=4)
    assert sorted(tuple(r) for r in got.collect()) == best_by_brute_force(rows, 4)


@pytest.mark.parametrize("k", [1, 5, 64, 200])
def test_op11_selection_from_slices(k):
    rng = np.random.default_rng(k)
    x = rng.integers(-300, 300, (130, 6))
    q = rng.integers(-300, 300, 6)
    low, slices = bit_sliced.slices_of(x)
    scores, constant = bit_sliced.sliced_scores(slices, low, q)
    valid = np.packbits(np.concatenate([np.ones(130, bool), np.zeros(62, bool)]), bitorder="little").view(np.uint64)
    at, value = bit_sliced.top_rows(scores, valid, k)
    exact = x @ q
    assert (value + constant == exact[at]).all()
    assert sorted(at.tolist()) == sorted(np.lexsort((np.arange(130), -exact))[:k].tolist())


# --- operator 12 ---------------------------------------------------------------------------

def test_op12_transducer_is_minimal():
    rng = random.Random(2)
    terms = sorted({bytes(rng.choice(b"abXY\xc3\xa9") for _ in range(rng.randrange(1, 9))) for _ in range(3000)})
    t = Transducer.from_bytes(build(terms).to_bytes())
    # right languages of the prefixes, brute force: one state each
    suffixes = collections.defaultdict(set)
    for w in terms:
        for k in range(len(w) + 1):
            suffixes[w[:k]].add(w[k:])
    assert len(t.final) == len({frozenset(s) for s in suffixes.values()})
    cuts = [0, *[k for k in range(1, len(terms)) if k % 500 == 0 and terms[k][:8] != terms[k - 1][:8]], len(terms)]
    parts = [("en", terms[a], a, build(terms[a:b])) for a, b in zip(cuts, cuts[1:], strict=False)]
    machine = Streamer([*parts, ("de", b"zz", 0, build([b"zz"]))])
    words = [*terms[::-1], b"zz", b"a" * 20, b"a\xc3"]
    buf = np.frombuffer(b" ".join(words), np.uint8)
    end = np.cumsum([len(w) + 1 for w in words]) - 1
    start = end - np.array([len(w) for w in words])
    order = {w: k for k, w in enumerate(terms)}
    assert machine.ordinals("en", buf, start, end).tolist() == [order.get(w, -1) for w in words]
    assert machine.ordinals("de", buf, start, end).tolist() == [0 if w == b"zz" else -1 for w in words]
    assert (machine.ordinals("fr", buf, start, end) == -1).all()
    with pytest.raises(ValueError):
        build([b"b", b"a"])


def terms_of(text):
    out, word = [], ""
    for c in (text or "") + " ":
        if c.isascii() and not c.isalpha():
            if word:
                out.append(word)
            word = ""
        else:
            word += c.lower() if c.isascii() else c
    return out


def divergence_by_brute_force(rows, least, best):
    rows = [(t or "", la or "", s or "") for _, t, la, s, _ in rows]
    out = []
    for lang in {r[1] for r in rows}:
        docs = [(terms_of(t), s) for t, la, s in rows if la == lang]
        df = collections.Counter(w for d, _ in docs for w in set(d))
        kept = sorted((w for w, n in df.items() if n >= least), key=str.encode)
        count = {s: collections.Counter() for _, s in docs}
        for d, s in docs:
            count[s].update(w for w in d if df[w] >= least)
        whole = sum(count.values(), collections.Counter())

        def share(c, kept=kept):
            n = sum(c.values()) + 2 * len(kept)
            return {w: 1 + 10 ** 9 * (c[w] + 2) // n for w in kept}
        p, q = {s: share(c) for s, c in count.items()}, share(whole)
        for s in count:
            pairs = sorted((-sum((p[s][w] - p[o][w]) ** 2 // (p[s][w] + p[o][w]) for w in kept), o.encode(), o) for o in count if o != s)
            out += [(lang, s, "pair", o, -v, r + 1) for r, (v, _, o) in enumerate(pairs)]
            top = sorted((-((p[s][w] - q[w]) ** 2 // (p[s][w] + q[w])), w.encode(), w) for w in kept if count[s][w] and p[s][w] > q[w])
            out += [(lang, s, "term", w, -v, r + 1) for r, (v, _, w) in enumerate(top[:best])]
    return sorted(out)


def divergence_corpus():
    rng = random.Random(4)
    pool = [*[f"{a}{b}" for a in "abcdefg" for b in ("lpha", "Éta", "x", "longerprefixed", "longerprefiy")], "ünï", "\U0001F600"]
    rows = []
    for k in range(160):
        text = " ".join(rng.choice(pool) + rng.choice(["", "!", "7", " \n"]) for _ in range(rng.randrange(0, 40)))
        rows.append((k, text, rng.choice(["en", "de", None, ""]), rng.choice(["a", "b", "ß", None, ""]), None))
    rows += rows[:5]
    rows += [(900, None, "en", "only null text", None), (901, "alone in its language", "xx", "a", 3), (902, "x " * 60000, "en", "long", 1),
             (None, "alpha alpha", "en", "a", 2)]
    return rows


def test_op12_is_exact(spark, monkeypatch):
    monkeypatch.setattr(divergence, "SHARD_TERMS", 12)
    monkeypatch.setattr(divergence, "SLAB_BYTES", 3000)      # several passes
    monkeypatch.setattr(divergence, "TILE", 2)
    rows = divergence_corpus()
    df = spark.createDataFrame([(*r, *MORE) for r in rows], DOCS)
    got = sorted(tuple(r) for r in divergence.source_divergence(df, least=4, best=3).collect())
    assert got == divergence_by_brute_force(rows, 4, 3)


def test_op12_small_tables(spark):
    df = spark.createDataFrame([(*r, *MORE) for r in divergence_corpus()], DOCS)
    assert divergence.source_divergence(df.limit(0)).collect() == []
    got = divergence.source_divergence(df, least=10 ** 6).collect()      # no kept terms
    assert got and {(r.part, r.value) for r in got} == {("pair", 0)}


def test_op12_shares_are_exact():
    rng = np.random.default_rng(1)
    for total, terms in ((0, 1), (10 ** 15, 10 ** 6), (10 ** 12 + 7, 3), (5, 5)):
        n = rng.integers(0, total + 1, 50)
        assert divergence.shares(n, total, terms).tolist() == [1 + 10 ** 9 * (int(x) + 2) // (total + 2 * terms) for x in n]


# --- operator 13 ---------------------------------------------------------------------------

def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def manifest_by_brute_force(rows):
    def field(x):
        return "-" if x is None else f"{len(str(x).encode())}:{x}"

    def leaf(i, text, lang, source, n):
        return sha("".join(map(field, (i, source, lang, n, text))))

    def tree(nodes):
        """Root, and for each node its siblings' (side, digest) per level."""
        paths, at, level = [[] for _ in nodes], list(range(len(nodes))), nodes
        while len(level) > 1:
            for k, path in enumerate(paths):
                other = at[k] ^ 1
                path.append((other < at[k], level[other] if other < len(level) else ""))
                at[k] //= 2
            level = [sha("".join(level[j:j + 2])) for j in range(0, len(level), 2)]
        return level[0], paths
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        trees[lang] = sorted((r[0] is not None, r[0] or 0, leaf(*r), k) for k, r in enumerate(rows) if r[2] == lang)
    done = {lang: tree([x[2] for x in t]) for lang, t in trees.items()}
    root, tops = tree([done[lang][0] for lang in langs])
    out = []
    for lang, top in zip(langs, tops, strict=True):
        subroot, paths = done[lang]
        for (_, _, own, k), path in zip(trees[lang], paths, strict=True):
            i, text, _, source, n = rows[k]
            hit = i is not None and n is not None and zlib.crc32(str(i).encode()) % 7 == 0
            end = leaf(i, text, lang, source, n + 1) if hit else own
            for left, other in path + top:
                end = sha(other + end if left else end + other)
            out.append((i, own, subroot, root, sha("".join(x for _, x in path + top)), end, end == root))
    return sorted(out, key=str)


def manifest_rows():
    rng = random.Random(8)
    rows = [(i, f"text {i} é", rng.choice(["en", "de"]), rng.choice(["a", None]), rng.choice([None, i])) for i in rng.sample(range(400), 300)]
    rows += [(2 ** 63 - 1, "x", "en", "a", 1), (-2 ** 63, "x", "en", "a", 1), (-1, "", "de", "", 0), (10 ** 12, None, "de", None, None)]
    rows += [(5, "alone", "fr", "b", 5), (6, "no language", None, "b", 6), (7, "no language", None, None, 7), (8, "empty language", "", "b", 8)]
    rows += [(None, "no id", "en", "a", 3), (None, "no id either", "en", "a", 4), (None, "no id", "en", "a", 3)]
    rows += [(77, f"one id {k % 9}", "es", "a", k % 3) for k in range(60)] + [(78, "same", "es", "a", 1)] * 40 + [(76, "before", "es", "a", 1)]
    return rows + [(9, "long " * 50000, "en", "a", 250000)]


@pytest.mark.parametrize("steps", [10, 2])
def test_op13_is_exact(spark, monkeypatch, steps):
    monkeypatch.setattr(manifest, "SAME_ROWS", 2)
    rows = manifest_rows()
    df = spark.createDataFrame([(*r, *MORE) for r in rows], DOCS)
    got = sorted((tuple(r) for r in manifest.merkle_manifest(df, steps=steps).collect()), key=str)     # 2: many rounds
    assert got == manifest_by_brute_force(rows)


def test_op13_small_tables(spark):
    df = spark.createDataFrame([(*r, *MORE) for r in manifest_rows()], DOCS)
    assert manifest.merkle_manifest(df.limit(0)).collect() == []
    one = [(3, "t", "en", "s", 1)]
    got = manifest.merkle_manifest(spark.createDataFrame(one, DOCS.replace(EXTRA, ""))).collect()
    assert [tuple(r) for r in got] == manifest_by_brute_force(one)
    assert got[0].root == got[0].leaf and got[0].proof_sha256 == sha("")


def test_op13_slots_are_gapless(spark):
    rows = [(i * 1000003 % 2 ** 40, "en", str(i)) for i in range(500)] + [(4, "en", "a")] * 30
    df = spark.createDataFrame([(f"={t}", i, leaf, k) for k, (i, t, leaf) in enumerate(rows)], "tree string, id long, leaf string, uid long")
    got = manifest.places(df).collect()
    assert sorted(r.slot for r in got) == list(range(530))
    assert [r.id for r in sorted(got, key=lambda r: r.slot)] == sorted(r[0] for r in rows)
