"""The dealt operators against brute force, on small tables with nulls, empty
and repeated rows, long texts and clashing further columns."""

import collections
import hashlib
import math
import random
import re
import string
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from forgestat.llm import bpe, chat_format, decontaminate, license_scan, lm_score, quality, sharding, textnp
from forgestat.llm.cap_filters import near_vectors
from forgestat.llm.decontaminate import contaminations, decontaminated
from forgestat.llm.language_id import fit_languages, forward_backward, identified, identify
from forgestat.llm.ngram_join import index_keys, ngram_components
from forgestat.llm.quality import isotonic, quality_kept, quality_scores
from forgestat.llm.sharding import karmarkar_karp, shard_by_bytes

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
EXTRA = ", score double, shard int, component_id long, n_words long, node long, key long, tokens string"


def frame(spark, rows, schema=DOCS, extra=False):
    if extra:
        rows = [(*r, 0.5, 1, 2, 3, 4, 5, "x") for r in rows]
    return spark.createDataFrame(rows, schema + (EXTRA if extra else ""))


def words(rng, n, pool=4000):
    return [f"w{rng.randrange(pool)}" for _ in range(n)]


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    texts = [" ".join(words(rng, rng.randrange(1, 90))) for _ in range(60)]
    base = words(rng, 120)
    for k in range(40):                                  # a group of near copies
        copy = list(base)
        for _ in range(k % 7):
            copy[rng.randrange(len(copy))] = f"edit{rng.randrange(6)}"
        texts.append(" ".join(copy))
    shared = words(rng, 40)
    texts += [" ".join(words(rng, 12) + shared + words(rng, 12)) for _ in range(20)]
    texts += [texts[0], texts[0].upper(), "", " \n ", "one", "ONE", "a b c d", None, " ".join(words(rng, 30000))]
    return [(k, t, "en", "s", None) for k, t in enumerate(texts)]


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def components_by_brute_force(rows):
    sets = {i: shingles(t) for i, t, *_ in rows}
    root = {i: i for i in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                    a, b = top(i), top(j)
                    root[max(a, b)] = min(a, b)
    return {i: (len(s), top(i)) for i, s in sets.items()}


def test_op2_components(spark, corpus):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_components(frame(spark, corpus, extra=True)).collect()}
    assert got == components_by_brute_force(corpus)


def test_op2_keys_meet(spark):
    """Any two similar sets share a key, whatever the classes are."""
    rng = np.random.default_rng(1)
    for _ in range(400):
        n = int(rng.integers(2, 80))
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        n = len(a)
        cut = int(rng.integers(0, max(1, n // 4) + 1))
        b = np.unique(np.concatenate([a[cut:], rng.integers(0, 1 << 63, int(rng.integers(0, n // 4 + 1)), dtype=np.uint64)]))
        both = len(np.intersect1d(a, b))
        if 100 * both < 75 * (len(a) + len(b) - both) or len(a) == len(b) == both:
            continue
        frequent = (rng.random(1 << 23) < rng.choice([0.0, 0.3, 0.8, 1.0])).astype(np.uint8)
        ka, kb = index_keys(a, frequent, 0.75)[0], index_keys(b, frequent, 0.75)[0]
        assert len(np.intersect1d(ka, kb))


def test_op2_nulls_repeats_and_empty_table(spark):
    rows = [(1, "a b c d e f", None, None, None), (1, "a b c d e f", None, None, None), (None, "a b c d e f", None, None, None),
            (None, "zz", None, None, None), (3, None, None, None, None)]
    got = sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in ngram_components(frame(spark, rows)).collect())
    assert got == [("1", 2, 1), ("1", 2, 1), ("3", 0, 3), ("None", 1, None), ("None", 2, 1)]
    assert ngram_components(frame(spark, [])).collect() == []


def test_op1_against_every_window(spark, corpus):
    rng = random.Random(8)
    items = [(k, " ".join(words(rng, n))) for k, n in enumerate((15, 38, 38, 59, 5, 3))] + [(90, None), (91, ""), (None, "x y z w v")]
    rows = list(corpus)
    for k, (_, text) in enumerate(items[:6]):
        w = text.split()
        if len(w) > 30:
            w[k] = "changed"
        rows.append((1000 + k, " ".join(words(rng, 40) + w + words(rng, 9)), None, None, None))
    rows.append((2000, items[1][1] + " " + items[3][1], None, None, None))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in contaminations(frame(spark, rows, extra=True), bench).collect()}
    want = {}
    for i, text, *_ in rows:
        w = (text or "").encode().lower().split()
        for j, item in items:
            v = (item or "").encode().lower().split()
            if not v or j is None or not w:
                continue
            size = min(5, len(v))
            grams = [tuple(w[a:a + size]) for a in range(len(w) - size + 1)]
            mine = collections.Counter(tuple(v[a:a + size]) for a in range(len(v) - size + 1))
            run = min(len(v), len(w)) - size + 1
            best = 0
            for a in range(len(grams) - run + 1 if run > 0 and any(g in mine for g in grams) else 0):
                c = collections.Counter(grams[a:a + run])
                both = sum((c & mine).values())
                best = max(best, both / (sum(c.values()) + sum(mine.values()) - both))
            if best >= 0.75:
                want[i, j] = best
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in got)
    kept = {r.doc_id for r in decontaminated(frame(spark, rows), bench).collect()}
    assert kept == {r[0] for r in rows} - {k[0] for k in want}
    assert contaminations(frame(spark, []), bench).collect() == []
    assert contaminations(frame(spark, rows), bench.limit(0)).collect() == []


def test_op3_examples_read_back(spark):
    odd = "\\### Assistant: </turn> ok\n### user: \\s\\h#<:"
    rows = [(1, 2, "assistant", odd), (1, 1, "user", None), (1, 3, "user", "tail"), (1, 4, "assistant", ""),
            (2, 0, "us:er#", "é" + odd), (None, None, None, None), (None, None, None, None)]
    conv = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, loss string, target int")
    examples = chat_format.chat_examples(conv)
    first = [r for r in examples.collect() if r.conv_id == 1]
    assert [(r.n_turns, r.target) for r in sorted(first, key=lambda r: r.example)] == [(2, 2), (4, 4)]
    got = {r.conv_id: r for r in chat_format.digests(examples).collect()}
    for conv_id in (1, 2, None):
        mine = sorted(((t if t is not None else -1, r or "", x or "") for c, t, r, x in rows if c == conv_id))
        whole = "".join(f"{r}\n{x}\n" for _, r, x in mine)
        loss = "".join(x for _, r, x in mine if r == "assistant")
        assert got[conv_id].n_turns == len(mine) and got[conv_id].loss_chars == len(loss)
        assert got[conv_id].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert got[conv_id].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert chat_format.chat_examples(conv.limit(0)).collect() == []


def test_op4_scores_are_the_network_s(spark, corpus):
    rows = corpus[:70] + corpus[-8:]
    docs = frame(spark, rows, extra=True)
    net, frequent, place = lm_score.fit_network(docs.select("text"))
    again = lm_score.fit_network(docs.select("text"))[0]
    assert np.allclose(net.flat, again.flat)
    table = net.table().reshape(lm_score.VOCABULARY, lm_score.VOCABULARY, lm_score.VOCABULARY)
    assert np.allclose(np.exp(table.astype(float)).sum(axis=2), 1, atol=1e-4)
    one = {h: c for h, c in zip(frequent.tolist(), place.tolist(), strict=True)}
    got = {r.doc_id: r for r in lm_score.lm_scores(docs).collect()}
    for i, text, *_ in rows:
        piece = next(textnp.pieces(pa.array([text], pa.string()), textnp.SPACE))
        ids = [one.get(h, lm_score.END + 1 + h % (lm_score.VOCABULARY - lm_score.END - 1)) for h in piece.word_hash().tolist()]
        ends = [lm_score.END, *ids, lm_score.END]
        want = sum(float(table[a, c, b]) for a, b, c in zip(ends, ends[1:], ends[2:]))
        assert got[i].n_tokens == len(ids) and math.isclose(got[i].log_likelihood, want, rel_tol=1e-5, abs_tol=1e-6)
        assert (got[i].mean_log_likelihood is None) == (not ids)
    assert lm_score.lm_scores(frame(spark, [])).collect() == []


@pytest.mark.parametrize("held", [1 << 16, 20])
def test_op4_words_have_probabilities(spark, corpus, monkeypatch, held):
    """p(class | left, right) p(word | class), with words held in the tasks or joined."""
    monkeypatch.setattr(lm_score, "HELD", held)
    rows = corpus[:70] + corpus[-8:] + [(900, "zzzgarbage", "en", "s", None), (None, "w1 w1 zzzgarbage", "en", "s", None)]
    docs = frame(spark, rows, extra=True)
    net, frequent, place = lm_score.fit_network(docs.select("text"))
    table = net.table().reshape((lm_score.VOCABULARY,) * 3)
    own = dict(zip(frequent.tolist(), place.tolist(), strict=True))
    hashes = {i: next(textnp.pieces(pa.array([t], pa.string()), textnp.SPACE)).word_hash().tolist() for i, t, *_ in rows}
    label = lambda h: own.get(h, lm_score.END + 1 + h % (lm_score.VOCABULARY - lm_score.END - 1))
    n = collections.Counter(h for ws in hashes.values() for h in ws)
    total = collections.Counter()
    for h, k in n.items():
        total[label(h)] += k
    assert len(n) > lm_score.VOCABULARY and math.isclose(          # the words' probabilities add up to those of their classes
        sum(k / total[label(h)] for h, k in n.items()), len(total), rel_tol=1e-9)
    got = {r.doc_id: r for r in lm_score.word_scores(docs).collect()}
    assert len(got) == len(rows)
    for i, ws in hashes.items():
        ends = [lm_score.END, *map(label, ws), lm_score.END]
        want = sum(float(table[a, c, b]) for a, b, c in zip(ends, ends[1:], ends[2:]))
        want += sum(math.log(n[h] / total[label(h)]) for h in ws)
        assert got[i].n_tokens == len(ws) and math.isclose(got[i].log_likelihood, want, rel_tol=1e-5, abs_tol=1e-6)
        assert (got[i].mean_log_likelihood is None) == (not ws)
    assert lm_score.word_scores(frame(spark, [])).collect() == []


def test_op4_gradient():
    rng = np.random.default_rng(2)
    left, right = rng.integers(0, 256, 6), rng.integers(0, 256, 6)
    counts = rng.integers(0, 3, (6, 256)).astype(float)
    net = lm_score.Network()
    grad, loss = net.gradient(left, right, counts)
    for k in rng.choice(len(grad), 40, replace=False):
        moved = net.flat.copy()
        moved[k] += 1e-5
        assert abs((lm_score.Network(moved).gradient(left, right, counts)[1] - loss) / 1e-5 - grad[k]) < 1e-2


def test_op5_places(spark):
    rows = [(1, "The MIT License. Apache-License, mit\nlicense"), (2, None), (3, ""), (4, "gnu general public license gnu general public"),
            (4, "CC  BY cc by-sa ccby"), (5, "GNU Lesser General Public License; BSD license"), (None, "é mit license")]
    docs = spark.createDataFrame([(*r, "x", 9) for r in rows], "doc_id long, text string, words string, places int")
    got = sorted((r.doc_id or 0, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels)
                 for r in license_scan.license_scan(docs).collect())
    assert got == [(0, 3, 1, 1, 1, "mit", "mit"), (1, 7, 3, 1, 5, "apache,mit", "apache,mit"),
                   (2, 0, 0, None, None, "", ""), (3, 0, 0, None, None, "", ""), (4, 6, 2, 0, 2, "cc-by", "cc-by"),
                   (4, 7, 1, 0, 0, "gpl", "gpl"), (5, 7, 0, None, None, "", "bsd,lgpl")]
    assert license_scan.license_scan(docs.limit(0)).collect() == []


def _licenses(text):
    """(template, start) by the definition: every key phrase at every place."""
    w = [x for x in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(str.maketrans(
        string.ascii_uppercase, string.ascii_lowercase))) if x]

    def stands(phrase, q):
        return q >= 0 and w[q:q + len(phrase.split())] == phrase.split()
    return [(k, at) for k, (template, _) in enumerate(license_scan.TEMPLATES) for at in range(len(w))
            if stands(template[0][0], at) and all(
                any(stands(phrase, at + o + d) for d in range(-license_scan.SLACK, license_scan.SLACK + 1))
                for phrase, o in template[1:])]


def test_op5_passages_against_every_place(spark):
    rng = random.Random(8)
    plain = [p.replace("[", "").replace("]", "") for p, _ in license_scan.PASSAGES]
    plain += [phrase for phrase, _ in license_scan.BASE + license_scan.ADDED]
    vocabulary = sorted({w for p in plain for w in p.split()}) + ["Zeile", "\u212Aopie", "\u0130x"]
    texts = ["SPDX-License-Identifier: Apache-2.0", "spdx license identifier: MIT", "\u212A " + plain[0], None, ""]
    for _ in range(160):
        t = []
        for _ in range(rng.randrange(1, 4)):
            p = rng.choice(plain).split()
            if rng.random() < 0.5:                       # words put in or left out, within the slack and beyond it
                at, n = rng.randrange(len(p)), rng.randrange(1, 12)
                p = p[:at] + rng.choices(vocabulary, k=n) + p[at:] if rng.random() < 0.6 else p[:at] + p[at + n:]
            t += rng.choices(vocabulary, k=rng.randrange(6)) + p
        texts.append(rng.choice([" ", "\n * ", ", "]).join(w.upper() if rng.random() < 0.1 else w for w in t))
    # a very long text: rare words of all templates everywhere
    texts.append(" ".join(rng.choices(vocabulary, k=20000) + [plain[4]] + rng.choices(plain, k=200)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: [tuple(x) for x in r.places] for r in license_scan.license_scan(docs).collect()}
    want = {i: sorted(_licenses(t or "")) for i, t in enumerate(texts)}
    assert got == want
    assert {k for found in want.values() for k, _ in found} == set(range(len(license_scan.TEMPLATES)))
    moved = [len(t) for t, _ in license_scan.TEMPLATES]
    assert sum(moved[k] > 1 for found in want.values() for k, _ in found) > 50


def test_op6_marginals_by_enumeration():
    rng = np.random.default_rng(4)
    emission, move, begin = rng.normal(size=(5, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    first = np.array([0, 4, 4, 5])
    got, moves, start = forward_backward(emission, first, move, begin, edges=True)
    weight = {}
    for path in np.ndindex(3, 3, 3, 3):
        weight[path] = math.exp(begin[path[0]] + sum(emission[k, p] for k, p in enumerate(path))
                                + sum(move[a, b] for a, b in zip(path, path[1:])))
    total = sum(weight.values())
    for k in range(4):
        for lab in range(3):
            assert math.isclose(got[k, lab], sum(w for p, w in weight.items() if p[k] == lab) / total, rel_tol=1e-9)
    assert math.isclose(moves.sum(), 3) and math.isclose(start.sum(), 2)


def test_op6_predictions(spark):
    rng = random.Random(1)
    parts = {"aa": ["kra", "ble", "ost"], "bb": ["ñue", "ião", "que"]}
    rows = [(k, " ".join("".join(rng.choice(parts[lang]) for _ in range(2)) for _ in range(rng.randrange(1, 40))), lang, None, None)
            for k in range(200) for lang in [rng.choice(["aa", "bb"])]]
    odd = [(900, None, "aa", None, None), (901, "", None, None, None), (902, "123 !! — …", None, None, None), (None, "krable ostkra", None, None, None)]
    docs = frame(spark, rows + odd, extra=True)
    model = fit_languages(docs)
    got = {r.doc_id: r for r in identify(docs, model).collect()}
    held = [r for r in rows if got[r[0]].held_out]
    assert held and sum(got[r[0]].lang_pred == r[2] for r in held) >= 0.95 * len(held)
    assert [got[k].lang_pred for k in (900, 901, 902, None)] == ["und", "und", "und", "aa"]
    assert all(0 <= r.score <= 1 for r in got.values())
    assert {r.doc_id for r in identified(docs, model).collect()} == set(got) - {900, 901, 902}
    assert identify(frame(spark, []), None).collect() == []
    assert fit_languages(frame(spark, [(1, "a", None, None, None)])) is None


def test_op7_shards(spark, corpus):
    rows = corpus + [(500 + k, corpus[3][1], None, None, None) for k in range(30)] + [(None, "x", None, None, None)] * 2
    got = shard_by_bytes(frame(spark, rows, extra=True), 5).collect()
    assert len(got) == len(rows) and {r.shard for r in got} <= set(range(5))
    by = collections.defaultdict(list)
    for r in got:
        by[r.shard].append(r)
    assert all(sorted(r.slot for r in v) == list(range(len(v))) for v in by.values())
    where = {}
    for r in got:
        assert where.setdefault(r.text_crc32, r.shard) == r.shard
    large = max(len((t or "").encode()) + 16 for _, t, *_ in rows)
    rest = sorted(sum(r.size for r in v) for v in by.values())
    assert rest[-1] <= max(large, rest[0] + 200)
    assert shard_by_bytes(frame(spark, []), 5).collect() == []


def _differencing(sizes, shards):
    """Karmarkar-Karp differencing with plain lists, by its definition."""
    parts = [(k, [(size, j, [k] if j == 0 else []) for j, size in enumerate([size] + [0] * (shards - 1))])
             for k, size in enumerate(sizes)]
    serial = len(parts)
    while len(parts) > 1:
        parts.sort(key=lambda p: (p[1][-1][0] - p[1][0][0], p[0]))
        (_, a), (_, b) = parts.pop(0), parts.pop(0)
        bins = sorted(((x[0] + y[0], i, x[2] + y[2]) for i, (x, y) in enumerate(zip(a, b[::-1], strict=True))),
                      key=lambda x: (-x[0], x[1]))
        parts.append((serial, bins))
        serial += 1
    return {k: shard for shard, x in enumerate(parts[0][1]) for k in x[2]}


def test_op7_against_brute_force(spark, corpus, monkeypatch):
    """Shards and slots of every row, one row with a third of all rows as copies among them."""
    monkeypatch.setattr(sharding, "SLOT_ROWS", 7)
    monkeypatch.setattr(sharding, "ITEMS_PER_SHARD", 4)
    rows = corpus + [(7, "many of one id", None, None, None)] * 60 + [(None, "no id", None, None, None)] * 15
    rows += [(7, "other text of the id", None, None, None), (901, "", None, None, None), (902, "long " * 9000, None, None, None)]
    shards, bundles = 6, 24
    size = {t or "": len((t or "").encode()) + 16 for _, t, *_ in rows}
    total, copies = collections.Counter(), collections.Counter(t or "" for _, t, *_ in rows)
    digest = {t: hashlib.md5(t.encode()).digest() for t in copies}
    bundle = {t: xxhash.xxh64_intdigest(digest[t], seed=42) for t in copies}
    bundle = {t: (h - (1 << 64) if h >> 63 else h) % bundles for t, h in bundle.items()}
    everything = sum(size[t] * n for t, n in copies.items())
    name = {t: (digest[t], -1) if size[t] * copies[t] * bundles > everything else (b"", bundle[t]) for t in copies}
    for t, n in copies.items():
        total[name[t]] += size[t] * n
    items = sorted(total, key=lambda x: (-total[x], *x))
    shard = {items[k]: s for k, s in _differencing([total[x] for x in items], shards).items()}
    parts = -(-len(rows) // 7)

    def place(i, t):
        h = 42 if i is None else xxhash.xxh64_intdigest(struct.pack("<q", i), seed=42)
        h = xxhash.xxh64_intdigest(struct.pack("<q", zlib.crc32(t.encode())), seed=h)
        return (h - (1 << 64) if h >> 63 else h) % parts
    want, used = [], collections.Counter()
    for i, t in sorted(((i, t or "") for i, t, *_ in rows),
                       key=lambda x: (place(*x), x[0] is not None, x[0] or 0, zlib.crc32(x[1].encode()), size[x[1]])):
        s = shard[name[t]]
        want.append((i, size[t], zlib.crc32(t.encode()), s, used[s]))
        used[s] += 1
    got = [(r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in shard_by_bytes(frame(spark, rows), shards).collect()]
    assert collections.Counter(got) == collections.Counter(want)


def test_op7_differencing_is_tight():
    rng = random.Random(6)
    sizes = [rng.randrange(1, 10_000) for _ in range(2000)]
    sums = [0] * 40
    for s, k in zip(sizes, karmarkar_karp(sizes, 40), strict=True):
        sums[k] += s
    assert max(sums) - min(sums) <= 20
    assert karmarkar_karp([5], 1) == [0] and karmarkar_karp([], 3) == []


def test_op8_links(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(600, 16))
    x[300:420] = x[0] + 0.2 * rng.normal(size=(120, 16))          # a dense group
    x[420:450] = x[1]
    rows = [(int(k), v.astype(np.float32).tolist()) for k, v in enumerate(x)]
    odd = [(700, None), (701, []), (702, [0.0] * 16), (703, [float("nan")] * 16), (704, [None] * 16), (705, [1.0, 2.0]),
           (706, [1.0, 2.0]), (None, rows[5][1])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows + odd], "vec_id long, embedding array<float>, n_links int, id int")
    got = {r.vec_id: r for r in near_vectors(df).collect()}
    u = np.array([r[1] for r in rows], dtype=np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    linked = (u @ u.T >= 0.9) & ~np.eye(len(u), dtype=bool)
    want = linked.sum(axis=1)
    have = np.array([got[k].n_links - (k == 5) for k in range(len(u))])
    assert (have <= want).all() and have.sum() >= 0.98 * want.sum()
    assert all(got[k].component_id == min(got[j].component_id for j in [k, *np.flatnonzero(linked[k])])
               for k in range(len(u)) if have[k] == want[k])
    assert [(got[k].n_links, got[k].component_id, got[k].kept) for k in (700, 701, 702, 703, 704)] == [(0, k, True) for k in range(700, 705)]
    assert (got[705].n_links, got[706].component_id, got[706].kept) == (1, 705, False)
    assert got[None].n_links == 1 + want[5] and got[None].component_id == got[5].component_id
    assert near_vectors(df.limit(0)).collect() == []


@pytest.mark.parametrize("kind", ["float", "double"])
def test_op8_recall_and_ids(spark, kind):
    """All links of a table with many against brute force: at least 0.99 of them, none
    below the threshold; a third of the rows around one vector, ids null and repeated."""
    rng = np.random.default_rng(21)
    x = rng.normal(size=(900, 24))
    x[:300] = x[0] + 0.3 * rng.normal(size=(300, 24))
    for k in range(300, 600, 4):                                  # small groups near the threshold
        x[k:k + 4] = x[k] + 0.28 * rng.normal(size=(4, 24))
    x = x.astype(np.float32 if kind == "float" else np.float64)
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], f"vec_id long, embedding array<{kind}>")
    more = spark.createDataFrame([(None, x[700].tolist()), (None, x[5].tolist()), (701, x[700].tolist()), (-1, [-0.0, 0.0]), (-2, [0.0, -1.0]),
                                  (-3, [-0.0, -1.0])], f"vec_id long, embedding array<{kind}>")
    got = near_vectors(df.unionByName(more)).collect()
    assert len(got) == 906
    u = x.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    linked = (u @ u.T >= 0.9) & ~np.eye(900, dtype=bool)
    want = linked.sum(axis=1) + linked[:, 5]                      # the copy of 5 without an id is linked as well
    want[5] += 1
    want[700] += 2
    by = collections.defaultdict(list)
    for r in got:
        by[r.vec_id].append(r)
    have = np.array([by[k][0].n_links for k in range(900) if k != 701])
    want = np.delete(want, 701)
    assert (have <= want).all() and have.sum() >= 0.99 * want.sum() and want.sum() > 20_000
    label = np.arange(900)
    label[701] = 700                                              # one id on two vectors is one node
    for _ in range(60):
        label = np.minimum(label, np.where(linked, label[None, :], 900).min(axis=1))
    assert np.mean([by[k][0].component_id == label[k] for k in range(900)]) >= 0.99
    assert sorted((r.n_links, r.component_id) for r in by[None]) == sorted([(by[5][0].n_links, by[5][0].component_id), (2, 700)])
    assert sorted(r.n_links for r in by[701]) == [0, 2] and {r.component_id for r in by[701]} == {700}
    assert [(by[k][0].n_links, by[k][0].component_id) for k in (-1, -2, -3)] == [(0, -1), (1, -3), (1, -3)]


ODD_TEXTS = ["", "  ", "\n\n a", "<|endoftext|> b<|startoftext|>", "İstanbul ΑΣ ΑΣΑ", "á ́b    x", "don't'll  it's 's",
             "日本 語 ١٢3", "é e ́\ń", "a\x00b \x85 c​", "x" * 5000, None, "tab\tsep\r\nq", "﻿   ok"]


@pytest.mark.parametrize("chunk_words", [1, 3])
def test_op9_is_the_tokenizer(spark, corpus, chunk_words):
    rows = [(k, t, None, None, None) for k, t in enumerate(ODD_TEXTS)] + [(100 + i, t, *r) for i, t, *r in corpus] + [(None, "a b", None, None, None)]
    tokenizer = bpe.ChunkCoder(bpe.public_tokenizer()).tokenizer
    got = {r.doc_id: r for r in bpe.bpe_encode(frame(spark, rows, extra=True), chunk_words=chunk_words).collect()}
    for i, text, *_ in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        assert got[i].n_tokens == len(ids) and bytes(got[i].ids) == np.asarray(ids, "<u4").tobytes()
        assert got[i].decoded == tokenizer.decode(ids, skip_special_tokens=False)
    assert bpe.bpe_encode(frame(spark, [])).collect() == []


def _agrees(coder, texts):
    piece = next(textnp.pieces(pa.array(texts), coder.cut_at, lower=False))
    for text, got in zip(texts, coder.encode(piece).to_pylist(), strict=True):
        ids = coder.tokenizer.encode(text, add_special_tokens=False).ids
        assert got["ids"] == np.asarray(ids, "<u4").tobytes() and got["n_tokens"] == len(ids), text
        assert got["decoded"] == coder.tokenizer.decode(ids, skip_special_tokens=False), text


def test_op9_takes_back_a_cut_that_does_not_agree():
    """A tokenizer that looks across white space: the chunks grow until they agree."""
    from tokenizers import Tokenizer, decoders, models, pre_tokenizers
    vocabulary = {c: k for k, c in enumerate(["a", "b", " ", "a b", "a "])}
    tokenizer = Tokenizer(models.BPE(vocab=vocabulary, merges=[("a", " "), ("a ", "b")]))
    tokenizer.pre_tokenizer, tokenizer.decoder = pre_tokenizers.Split("zzz", "isolated"), decoders.Fuse()
    _agrees(bpe.ChunkCoder(tokenizer, 1), ["a b a a b b", "", "b", "a  a\nb"])


@pytest.mark.parametrize("chunk_words", [1, 3, None])
def test_op9_tests_every_distinct_join(chunk_words):
    """A normalizer that joins two words of many with the same first and last letters."""
    from tokenizers import Tokenizer, normalizers
    tokenizer = Tokenizer.from_file(bpe.public_tokenizer())
    assert bpe.apart(tokenizer)
    tokenizer.normalizer = normalizers.Sequence([normalizers.Replace("foo bar", "foobar"), tokenizer.normalizer])
    assert not bpe.apart(tokenizer)
    rng = random.Random(5)
    texts = ["xo bz foo bar", "foo bar foo bar", "xo bz", "foo bar", "foo  bar"]
    texts += [" ".join(rng.choice(["foo", "bar", "xo", "bz", "zoo"]) for _ in range(rng.randrange(1, 60))) for _ in range(30)]
    coder = bpe.ChunkCoder(tokenizer, chunk_words)
    _agrees(coder, texts)
    _agrees(coder, texts[::-1])                              # from what it keeps


def test_op9_cuts_by_content_and_tests_the_joins_of_the_default_tokenizer():
    """The rolling hash decides the cuts, and every distinct join is re-encoded."""
    coder = bpe.ChunkCoder(bpe.public_tokenizer())
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(900)]
    text = " ".join(rng.choice(words) for _ in range(6000))
    piece = next(textnp.pieces(pa.array([text, "x " + text]), coder.cut_at, lower=False))
    start, end, hashes, first = coder._chunks(piece)
    assert 40 < first[1] - first[0] < 300 and set(hashes[1:first[1]].tolist()) <= set(hashes[first[1]:].tolist())
    raw = piece.raw.tobytes()
    joins = {(raw[:a].rsplit(None, 1)[-1], raw[b:].split(None, 1)[0]) for a, b in zip(end[:first[1] - 1], start[1:first[1]], strict=True)}
    assert len(coder.agrees) == len(joins) and all(coder.agrees.values())


def test_op9_takes_back_a_cut_between_words_that_seem_apart():
    from tokenizers import Tokenizer, normalizers
    tokenizer = Tokenizer.from_file(bpe.public_tokenizer())
    tokenizer.normalizer = normalizers.Sequence([normalizers.Replace("foo bar", "foobar"), tokenizer.normalizer])
    coder = bpe.ChunkCoder(tokenizer, 1)
    coder.apart = True
    _agrees(coder, ["xo bz foo bar", "foo bar foo bar", "bar foo"])


def test_op9_other_public_tokenizers():
    """Tokenizers with other steps, among them such that decode bytes or mark white space."""
    import os

    import public_tokenizers
    folder = os.path.dirname(public_tokenizers.path("word_bpe_49k.json"))
    rng = random.Random(6)
    texts = [" ".join(rng.choice(["the", "Cats", "don't", "12", "e\u0301t", "\u0301x", "\tq", "\u3000", "<s>"])
                      for _ in range(rng.randrange(1, 40))) for _ in range(20)] + ["", " lead", "trail \n", "a\n\nb"]
    names = [n for n in sorted(os.listdir(folder)) if n.endswith(".json")]
    for name in names:
        try:
            coder = bpe.ChunkCoder(os.path.join(folder, name))
        except Exception:                                    # a JSON file that is no tokenizer
            assert name != "word_bpe_49k.json"
            continue
        _agrees(coder, texts)


def test_op1_tables_hold_all_within_the_radius():
    rng = np.random.default_rng(4)
    prints = rng.integers(0, 256, (300, 8), dtype=np.uint8)
    got = prints[rng.integers(0, 300, 500)].copy()
    for row, flips in enumerate(rng.integers(0, 40, len(got))):
        bits = rng.choice(64, flips, replace=False)
        np.bitwise_xor.at(got[row], bits // 8, (1 << (bits % 8)).astype(np.uint8))
    far = np.unpackbits(got[:, None, :] ^ prints[None, :, :], axis=2).sum(axis=2)
    want = {(w, j, int(far[w, j])) for w, j in zip(*(x.tolist() for x in np.nonzero(far <= decontaminate.RADIUS)), strict=True)}
    tables = decontaminate.BlockTables(prints)
    found = [x for part in tables.within(got) for x in zip(*(c.tolist() for c in part), strict=True)]
    assert len(found) == len(set(found)) and set(found) == want
    assert list(tables.within(got[:0])) == []


def test_op10_scores(spark):
    rng = random.Random(2)
    rows, marks = [], []
    for k in range(400):
        good = rng.random() < 0.7
        w = words(rng, rng.randrange(5, 60))
        rows.append((k, " ".join(w) + "." if good else " ".join(x.upper() + "$$$" for x in w), None, None, None))
        marks.append((k, int(good), 0))
    odd = [(900, None, None, None, None), (901, "", None, None, None), (None, "abc", None, None, None)]
    docs = frame(spark, rows + odd, extra=True)
    labels = spark.createDataFrame(marks + [(1, None, 1), (2, 7, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality_scores(docs, labels).collect()}
    held = [m for m in marks if got[m[0]].held_out]
    assert held and sum(got[k].predicted == y for k, y, _ in held) >= 0.97 * len(held)
    assert got[900].score == got[901].score and all(0 <= r.score <= 1 for r in got.values()) and len(got) == 403
    kept = {r.doc_id for r in quality_kept(docs, labels).collect()}
    assert kept == {k for k, r in got.items() if r.predicted}
    assert {r.score for r in quality_scores(docs, labels.limit(0)).collect()} == {0.5}
    assert quality_scores(frame(spark, []), labels).collect() == []


def test_op10_normal_equations_and_kernel(spark):
    """Weights against a ridge fit of all training rows at once, features against the
    Gaussian kernel; repeated rows, a very long text and ties at the threshold."""
    rng = random.Random(4)
    rows = [(k, " ".join(words(rng, rng.randrange(1, 80))) + rng.choice(["", "!!!", " $$ $$", "\n\n"]), None, None, None) for k in range(300)]
    rows += rows[:40] + [(400, "long Words, here. " * 40000, None, None, None)]
    marks = [(k, int("$" not in t)) for k, t, *_ in rows[:300]] + [(3, 0), (3, 1), (400, 1)]
    stats = quality.statistics(frame(spark, rows).repartition(7)).toPandas()
    x = np.stack(stats["stats"].to_numpy())
    model = quality.fit_quality(quality.statistics(frame(spark, rows).repartition(7)),
                                spark.createDataFrame(marks, "doc_id long, quality int"))
    assert np.allclose(model.mean, x.mean(axis=0)) and np.allclose(model.scale, np.where(x.std(axis=0) > 1e-12, x.std(axis=0), 1))
    z, y = [], []
    for i, held, s in zip(stats["doc_id"], stats["held_out"], x, strict=True):
        assert held == (zlib.crc32(str(int(i)).encode()) % 5 == 0)
        for k, label in marks:
            if k == i and not held:
                z.append(model.expand(s[None, :])[0])
                y.append(label)
    z, y = np.array(z), np.array(y, dtype=float)
    ridge = np.eye(z.shape[1]) * quality.RIDGE * len(y)
    ridge[-1, -1] = 0
    want = np.linalg.solve(z.T @ z + ridge + 1e-9 * np.eye(z.shape[1]), z.T @ y)
    assert np.allclose(z @ model.weights, z @ want, atol=1e-6)
    # random features: inner products near exp(-|a - b| ** 2 / 2) of the scaled statistics
    a = np.clip((x[:60] - model.mean) / model.scale, -6, 6) / math.sqrt(quality.N_STATS)
    kernel = np.exp(-((a[:, None, :] - a[None, :, :]) ** 2).sum(axis=2) / 2)
    near = model.expand(x[:60])[:, :-1]
    assert np.abs(near @ near.T - kernel).max() < 5 / math.sqrt(quality.FEATURES)
    # a score equal to the threshold is predicted 1
    docs, labels = frame(spark, rows), spark.createDataFrame(marks, "doc_id long, quality int")
    scores = collections.defaultdict(set)
    for r in quality_scores(docs, labels).collect():
        scores[r.doc_id].add((r.score, r.predicted))
    assert all(len(v) == 1 for v in scores.values())
    tie = sorted(s for v in scores.values() for s, _ in v)[150]
    got = {r.doc_id: r for r in quality_scores(docs, labels, threshold=tie).collect()}
    assert any(r.score == tie for r in got.values()) and all(r.predicted == int(r.score >= tie) for r in got.values())


def test_op10_isotonic():
    x, y = isotonic(np.arange(5.0), np.array([0.1, 0.5, 0.3, 0.2, 0.9]), np.ones(5))
    assert np.allclose(y, [0.1, 1 / 3, 0.9]) and np.allclose(x, [0, 2, 4])


def test_words_hash_alike_anywhere():
    piece = next(textnp.pieces(pa.array(["ab  CD ab", None, "", "cd", "ab" * 9]), textnp.SPACE))
    h = piece.word_hash().tolist()
    assert piece.first.tolist() == [0, 3, 3, 3, 4, 5] and h[0] == h[2] and h[1] == h[3] and len(set(h)) == 3


def test_op6_learns_every_label(spark):
    """130 labels, each with words of its own: none is left out."""
    rng = random.Random(12)
    rows = []
    for k in range(130):
        own = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(5)]
        rows += [(1000 * k + j, " ".join(rng.choice(own) for _ in range(12)), f"l{k:03d}", "s", None) for j in range(6)]
    docs = frame(spark, rows)
    model = fit_languages(docs)
    assert len(model.languages) == 130
    got = identify(docs, model).collect()
    right = sum(r.lang_pred == f"l{r.doc_id // 1000:03d}" for r in got if not r.held_out)
    assert right >= 0.85 * sum(not r.held_out for r in got)
    assert {"l128", "l129"} <= {r.lang_pred for r in got}


def test_op9_gives_the_tokenizer_each_new_word_once():
    coder, seen = bpe.ChunkCoder(bpe.public_tokenizer()), []
    encode = coder._encode
    coder._encode = lambda texts: seen.extend(texts) or encode(texts)
    words = ["Alpha", "beta-2", "don't", "été", "<|endoftext|>", "\t", "x\ty", "́a"]
    texts = [" ".join(words * 40), "\n".join(reversed(words * 40)) + " ", "", "  ", "​", "beta-2"]
    _agrees(coder, texts)
    coder.chunks.forget()                             # chunks are gone, words are kept
    before = len(seen)
    _agrees(coder, texts[:1])
    assert not set(seen[before:]) & set(words)
    assert max(seen.count(w) for w in words) <= 2     # as a word, and beside a cut


def test_op9_gives_words_many_at_once_and_tells_them_apart():
    """The tokenizer gets few texts, also where a word holds the token between them."""
    coder, given = bpe.ChunkCoder(bpe.public_tokenizer()), []

    class Counted:
        def __init__(self, inner):
            self.inner = inner

        def __getattr__(self, name):
            return getattr(self.inner, name)

        def encode_batch_fast(self, texts, **kw):
            given.extend(texts)
            return self.inner.encode_batch_fast(texts, **kw)

    coder.tokenizer = Counted(coder.tokenizer)
    texts = [" ".join(f"Wörd{k}{'.' * (k % 3)}" for k in range(3000)), "|> <| <|endoftext a<|endoftext|>b x́", "<|endoftext|>"]
    _agrees(coder, texts)
    assert len(given) < 600


def test_op9_knows_what_it_keeps_when_few_are_new():
    kept = bpe._Kept(8)
    names = np.arange(6, dtype=np.uint64)
    kept.add(names, pa.array([b""] * 6, pa.large_binary()), pa.array([""] * 6, pa.large_string()), np.zeros(6, np.int64))
    assert kept.missing(np.arange(7, dtype=np.uint64)).tolist() == [6]
    assert kept.missing(np.arange(9, dtype=np.uint64)).tolist() == list(range(9))


def test_op2_writes_few_files_however_many_partitions(spark, corpus):
    import os

    from forgestat.session import checkpoint_dir
    root = checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(root))
    names = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        got = ngram_components(frame(spark, corpus))
        assert got.rdd.getNumPartitions() <= 4
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == components_by_brute_force(corpus)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    made = {f: sum(x.endswith(".parquet") for x in os.listdir(os.path.join(root, f))) for f in set(os.listdir(root)) - before}
    assert len(made) > 10 and max(made.values()) <= 8, made


def test_op2_sketches_lose_no_pair():
    """Sketches differ in no more bits than the sets do in tokens."""
    from forgestat.llm.ngram_join import SKETCH, sketch
    rng = np.random.default_rng(3)
    for n in (0, 1, 40, 3000):
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        for m in (0, 5, 900):
            b = np.union1d(a[m:], rng.integers(0, 1 << 63, m // 2, dtype=np.uint64))
            apart = int(np.bitwise_count((sketch(a) ^ sketch(b)).view(np.uint64)).sum())
            differ = len(np.setxor1d(a, b))
            assert apart <= differ and (apart - differ) % 2 == 0 and len(sketch(a)) * 64 == SKETCH


def test_op2_pairs_of_a_large_group_of_near_copies(spark, monkeypatch):
    """Texts of one base that are too far from each other share keys, and are not paired all the same."""
    from forgestat.llm import ngram_join
    rng = random.Random(11)
    few, base = words(rng, 12), words(rng, 60)
    rows = []
    for k in range(600):
        text = list(base)
        for _ in range(rng.randint(1, 5)):
            text[rng.randrange(len(text))] = rng.choice(few)
        rows.append((k, " ".join(text), None, None, None))
    rows += [(k, " ".join(words(rng, 50)), None, None, None) for k in range(5, 9)]   # ids of two texts
    made, plain = {}, ngram_join.saved

    def counting(df, name, *args, **kw):
        out = plain(df, name, *args, **kw)
        made[name] = made.get(name, 0) + out.count()
        return out
    monkeypatch.setattr(ngram_join, "saved", counting)
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in ngram_components(frame(spark, rows)).collect()}
    want = components_by_brute_force(rows[:600])
    assert got == {(k, n, c) for k, (n, c) in want.items()} | {(k, 46, want[k][1]) for k in range(5, 9)}
    assert made["more"] < 2 * len(rows), made
