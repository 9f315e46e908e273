"""Operator 2: n-gram Jaccard self-join by token-combination prefixes.

A document's tokens are its distinct 5-word shingles (64-bit hashes). All
documents order their tokens alike: tokens of the rare class first, then those
of the frequent class, by hash within a class. For a partner of similarity
J >= t the overlap s of two sets of n and m tokens is at least t/(1+t)*(n+m),
so at most n - s tokens of either side are not shared. From that follow the
two kinds of index keys a document needs, and no others:

* single rare tokens: the first common token stands at position <= n - ceil(t*n),
  so the rare tokens up to there are indexed;
* combinations of two neighbouring frequent tokens, on a longer prefix: if no
  rare token is shared, all s shared tokens are frequent. Each unshared token
  spoils at most two neighbour pairs of its own list and one of the partner's,
  so fewer than T = 2*u + v + 1 neighbour pairs precede the first pair that both
  lists have, where u and v count the unshared frequent tokens; with r rare
  tokens 2*u + v <= n*(2 - 3*t/(1+t)) - 2*r + m*(1 - 3*t/(1+t)), largest at m = t*n.

The classes come from counts over all documents, folded into a bit map of
fixed size; they (and hash collisions in the map) decide which kind of key is
used, never whether a pair is found.

Equal sets are made one node first, so copies are indexed once. Of each key the
row with the fewest tokens before it leads, and every other row first proposes
one pair only, with its leader. What is verified joins components. Only rows
that are not in their leader's component then propose the remaining pairs of
their keys, between components. Pairs inside a component are never listed, and
no link between components is lost. A pair is proposed at all only within the
bounds that the two sizes set: on the lengths, on the places of a single key
(it may be the first common token), and on the ranks of a combination (it may
be the first common one, see above, with u and v for this pair).

Where many rows of one key stay outside their leader's component, most of their
pairs are of texts that have much in common and yet too little. There each row
brings a sketch of its set, SKETCH parity bits: two sets differ in at least as many
tokens as their sketches in bits, and a pair whose sketches differ in more
than its sizes allow is never made. No pair that reaches the similarity is lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgestat.llm import textnp
from forgestat.llm.common import documents_of, in_few, saved
from forgestat.llm.components import components

CLASS_BITS = 1 << 23      # size of the bit map of frequent tokens (1 MiB)
FREQUENT = 8              # counted repeats from which a token is frequent
COUNTED = 1 << 20         # tokens a task counts at a time
VERIFIED = 1 << 13        # pairs that a task verifies at least, each with two token sets
BROADCAST_IDS = 2_000_000  # ids that may be broadcast (8 or 16 bytes each)
CROWD = 16                # rows of a key outside their leader's component from which pairs are sketched first
SKETCH = 1024             # bits of a set's sketch: tells sets of up to some 1000 tokens apart
BROADCAST_SKETCHES = 1 << 17  # sketches that may be broadcast (144 bytes each)

_SETS = "doc_id long, n long, fa long, fb long, token long, c long"
_INDEX = "key long, node long, n int, pos int, rank int"
_LED = _INDEX + ", l_node long, l_n int, l_pos int, l_rank int"
_BITS = [f"s{i}" for i in range(SKETCH // 64)]
_SKETCHES = "s_node long, s_n int, " + ", ".join(f"{c} long" for c in _BITS)


def _arrow(schema: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32()}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in schema.split(", ")])


def _signed(a: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(a).view(np.int64)


def _fingerprint(tokens: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums over mixed tokens: the same for the same set."""
    a = textnp.mix(tokens + np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64)
    b = textnp.mix(tokens ^ np.uint64(0xD1B54A32D192ED03)).sum(dtype=np.uint64)
    return int(a.view(np.int64)), int(b.view(np.int64))


def _token_sets(batches: Iterator[pa.RecordBatch]):
    """(doc ids, list of token arrays) for bounded pieces of the batches."""
    for batch in batches:
        ids = batch.column("doc_id")
        for piece in textnp.pieces(batch.column("text"), textnp.SPACE):
            yield ids.slice(piece.lo, piece.hi - piece.lo), list(textnp.shingle_sets(piece))


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of two kinds: per document its set's size and fingerprint; per token
    met more than once in a bounded stretch of the task its count. A set that the
    task has met counts once, so that copies make no token frequent by themselves."""
    schema = _arrow(_SETS)

    def counts(held):
        tokens, c = np.unique(np.concatenate(held), return_counts=True)
        tokens, c = tokens[c > 1], c[c > 1]
        none = pa.nulls(len(tokens), pa.int64())
        return pa.RecordBatch.from_arrays([none, none, none, none, pa.array(_signed(tokens)),
                                           pa.array(c.astype(np.int64))], schema=schema)
    held, n_held, met = [], 0, set()
    for ids, sets in _token_sets(batches):
        prints = [_fingerprint(s) for s in sets]
        none = pa.nulls(len(ids), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array([len(s) for s in sets], pa.int64()),
             pa.array([p[0] for p in prints], pa.int64()), pa.array([p[1] for p in prints], pa.int64()),
             none, none], schema=schema)
        for p, s in zip(prints, sets, strict=True):
            if p not in met:
                if len(met) >= 1 << 17:
                    met.clear()
                met.add(p)
                held.append(s)
                n_held += len(s)
        if n_held >= COUNTED:
            yield counts(held)
            held, n_held = [], 0
    if n_held:
        yield counts(held)


def _slot(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(41)).astype(np.int64)      # 23 bits


def _class_map(described: DataFrame) -> np.ndarray:
    """Bit map of the frequent tokens; at most CLASS_BITS / 64 words arrive here."""
    slots = (described.filter("token is not null").groupBy("token").agg(F.sum("c").alias("c"))
             .filter(F.col("c") >= FREQUENT)
             .select(F.shiftrightunsigned("token", 41).alias("s"))
             .groupBy(F.shiftright("s", 6).alias("w"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(s & 63 as int))")).alias("bits")))
    words = np.zeros(CLASS_BITS // 64, dtype=np.int64)
    got = slots.toArrow()
    words[got["w"].to_numpy().astype(np.int64)] = got["bits"].to_numpy()
    return np.unpackbits(words.view(np.uint8), bitorder="little")


def index_keys(tokens: np.ndarray, frequent: np.ndarray, t: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of one document (sorted distinct tokens), how many of its tokens
    cannot be shared with a partner that is found first by the key, and the rank
    of a combination among the document's (-1 for single tokens)."""
    n = len(tokens)
    often = frequent[_slot(tokens)].astype(bool)
    rare, often = tokens[~often], tokens[often]
    single = rare[:n - math.ceil(t * n - 1e-9) + 1]
    q = 3 * t / (1 + t)
    pairs = math.floor((2 - q) * n + (1 - q) * t * n + 1e-9) - 2 * len(rare) + 1 if q >= 1 else len(often)
    pairs = min(max(pairs, 0), max(len(often) - 1, 0))
    pair = textnp.mix(textnp.mix(often[:pairs]) * np.uint64(0xD6E8FEB86659FD93) + often[1:pairs + 1])
    return (np.concatenate([single, pair]),
            np.concatenate([np.arange(len(single)), np.full(pairs, len(rare))]).astype(np.int32),
            np.concatenate([np.full(len(single), -1), np.arange(pairs)]).astype(np.int32))


def _indexer(bits: bytes, t: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little")
        schema = _arrow(_INDEX)
        for ids, sets in _token_sets(batches):
            keys, nodes, ns, poss, ranks = [], [], [], [], []
            for node, tokens in zip(ids.to_pylist(), sets, strict=True):
                if not len(tokens) or node is None:
                    continue
                k, pos, rank = index_keys(tokens, frequent, t)
                keys.append(k)
                poss.append(pos)
                ranks.append(rank)
                nodes.append(np.full(len(k), node, np.int64))
                ns.append(np.full(len(k), len(tokens), np.int32))
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_signed(np.concatenate(keys))), pa.array(np.concatenate(nodes)),
                     pa.array(np.concatenate(ns)), pa.array(np.concatenate(poss)),
                     pa.array(np.concatenate(ranks))], schema=schema)
    return run


def _led(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key -> the rows of keys that two rows or more have, each
    with its key's first row, the leader.

    Held are the key's first row and the last row, whatever the size of a group.
    """
    schema = _arrow(_LED)
    head = last = None               # first row of the open key and last row, as (key, node, n, pos, rank)
    given = False                    # whether the last row has been given out
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(c).to_numpy() for c in ("key", "node", "n", "pos", "rank")]
        if last is not None:
            cols = [np.concatenate([[x], c]).astype(c.dtype) for x, c in zip(last, cols, strict=True)]
        key = cols[0]
        n = len(key)
        first = np.concatenate([[True], key[1:] != key[:-1]])
        start = np.maximum.accumulate(np.where(first, np.arange(n), 0))
        lead = [c[start] for c in cols[1:]]
        if last is not None:         # the first group goes on from before
            own = start == 0
            lead = [np.where(own, x, c).astype(c.dtype) for x, c in zip(head[1:], lead, strict=True)]
        keep = np.zeros(n, dtype=bool)
        keep[1:] |= ~first[1:]
        keep[:-1] |= ~first[1:]
        if last is not None and given:
            keep[0] = False
        out = np.flatnonzero(keep)
        if len(out):
            yield pa.RecordBatch.from_arrays([pa.array(c[out]) for c in [*cols, *lead]], schema=schema)
        given = bool(keep[-1]) or (n == 1 and given)
        head = tuple([key[-1]] + [c[-1] for c in lead])
        last = tuple(c[-1] for c in cols)


def _sets_of(short: bool):
    """Token sets of texts; ``short``: the distinct last 16 bits of the tokens
    and how many tokens share theirs with another."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sets in _token_sets(batches):
            if short:
                cut = [np.unique(s.astype(np.uint16)).view(np.int16) for s in sets]
                out = pa.array(cut, pa.list_(pa.int16()))
            else:
                cut, out = sets, pa.array([_signed(s) for s in sets], pa.list_(pa.int64()))
            n = pa.array([len(s) for s in sets], pa.int64())
            extra = pa.array([len(s) - len(c) for s, c in zip(sets, cut, strict=True)], pa.int64())
            yield pa.RecordBatch.from_arrays([ids, n, extra, out], names=["doc_id", "n", "extra", "tokens"])
    return run


def sketch(tokens: np.ndarray) -> np.ndarray:
    """Parity of the distinct tokens that end in each of SKETCH values, as 64-bit words.
    A token that only one of two sets has flips one bit, so the sketches of two sets
    differ in no more bits than the sets in tokens."""
    odd = np.bincount((tokens & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = _arrow(_SKETCHES)
    for ids, sets in _token_sets(batches):
        bits = np.array([sketch(s) for s in sets], dtype=np.int64).reshape(len(sets), len(_BITS))
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array([len(s) for s in sets], pa.int32()),
             *[pa.array(np.ascontiguousarray(c)) for c in bits.T]], schema=schema)


def _alike(a: str, b: str, num: int, den: int):
    """Whether the sketches of a pair differ in no more bits than its sizes allow tokens
    that only one of the two has; the columns of either end start with ``a`` and ``b``."""
    na, nb = (F.col(f"{x}n").cast("long") for x in (a, b))
    apart = sum((F.bit_count(F.col(f"{a}{c}").bitwiseXOR(F.col(f"{b}{c}"))) for c in _BITS), F.lit(0))
    return apart <= na + nb - 2 * F.ceil((na + nb) * num / (num + den) - 1e-9)


def _bounds(a: str, b: str, num: int, den: int):
    """Bounds of a pair, in whole numbers (t = num / den); the columns of either
    end start with ``a`` and ``b``."""
    na, nb, pa_, pb, ra, rb = (F.col(f"{x}{c}").cast("long") for c in ("n", "pos", "rank") for x in (a, b))
    fa, fb, both = na - pa_, nb - pb, num + den
    need = F.ceil((na + nb) * num / both - 1e-9)               # least overlap
    # u = fa - overlap and v = fb - overlap tokens are not shared
    ranks = ((ra <= 2 * fa + fb - 3 * need) & (rb <= 2 * fb + fa - 3 * need)
             & (ra + rb <= 3 * (fa + fb - 2 * need)))
    return ((na * num <= nb * den) & (nb * num <= na * den) & (F.least(fa, fb) >= need)
            & ((ra < 0) | (rb < 0) | ranks))


def _pair(a: str, b: str) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _verified(texts: DataFrame, pairs: DataFrame, num: int, den: int, name: str, short: bool = False) -> DataFrame:
    """Of written pairs, as a written table, the pairs ``(a, b)`` whose exact Jaccard similarity of the token sets
    reaches num / den. Sets are made anew from the texts; that of ``a`` travels
    once for each of its pairs, that of ``b`` once.

    With ``short`` only the last 16 bits of the tokens travel. Two sets share at
    most as many tokens as they share such ends, plus the tokens of ``a`` that
    have an end in common, so no pair that reaches num / den is lost; the result
    then holds further pairs.
    """
    rows = pairs.count()
    partners = saved(pairs.groupBy("a").agg(F.collect_list("b").alias("partners"))
                     .withColumnRenamed("a", "doc_id"), "partners", rows)
    ends = saved(pairs.select(F.col("b").alias("doc_id")).distinct(), "ends", rows)

    def sets(ids: DataFrame) -> DataFrame:
        return (texts.join(_maybe_broadcast(ids), "doc_id", "left_semi")
                .mapInArrow(_sets_of(short), "doc_id long, n long, extra long, tokens array<"
                            + ("smallint>" if short else "bigint>")))
    a = (sets(partners.select("doc_id")).join(_maybe_broadcast(partners), "doc_id")
         .select(F.col("doc_id").alias("a"), F.col("n").alias("na"), "extra", F.col("tokens").alias("ta"),
                 F.explode("partners").alias("b")))
    b = sets(ends).select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
    found = (a.join(b, "b").withColumn("both", F.size(F.array_intersect("ta", "tb")) + F.col("extra"))
             .filter(F.col("both") * den >= (F.col("na") + F.col("nb") - F.col("both")) * num).select("a", "b"))
    return saved(found.distinct() if short else found, name, rows, VERIFIED)


def _sketched(texts: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows of keys with the sketch of their set, as a written table. A node of several
    texts has a row for each, told apart by the set's size (or kept with either sketch)."""
    rows = saved(rows, "crowd")
    nodes = saved(rows.select(F.col("node").alias("doc_id")).distinct(), "nodes", rows.count())
    sketches = saved(texts.join(_maybe_broadcast(nodes), "doc_id", "left_semi")
                     .mapInArrow(_sketches, _SKETCHES).distinct(), "sketches", nodes.count())
    if sketches.count() <= BROADCAST_SKETCHES:
        sketches = F.broadcast(sketches)
    return saved(rows.join(sketches, (F.col("node") == F.col("s_node")) & (F.col("n") == F.col("s_n")))
                 .drop("s_node", "s_n"), "sketched")


def ngram_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                num: int = 75, den: int = 100) -> tuple[DataFrame, DataFrame]:
    """Documents with their class of equal sets, and the links between classes.

    First result: one row per input row ``(doc_id, n_shingles, class_id)``;
    ``class_id`` is the smallest id with the same non-empty set, or the own id
    for an empty set. Second: ``(a, b)`` verified links between class ids that
    connect every two classes which links connect (links inside a component
    that are not needed for that are not listed).
    """
    spark, t = docs.sparkSession, num / den
    texts = documents_of(docs, id_col, text_col)
    described = saved(texts.mapInArrow(_describe, _SETS), "sets")
    per_doc = described.filter("n is not null").select("doc_id", "n", "fa", "fb")
    rows, tokens = per_doc.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    classes = saved(per_doc.filter("n > 0").groupBy("fa", "fb", "n").agg(F.min("doc_id").alias("class_id")),
                    "classes", rows)
    members = saved(
        per_doc.join(classes, ["fa", "fb", "n"], "left")
        .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("class_id", "doc_id").alias("class_id")),
        "members", rows)

    frequent = np.packbits(_class_map(described), bitorder="little").tobytes()
    # copies are not indexed: ids without a row that names its class
    copies = saved(members.filter("n_shingles > 0 and doc_id is not null").groupBy("doc_id")
                   .agg(F.max((F.col("class_id") == F.col("doc_id")).cast("int")).alias("own"))
                   .filter("own = 0").select("doc_id"), "copies", rows)
    named = texts.join(_maybe_broadcast(copies), "doc_id", "left_anti")
    led = saved(named.mapInArrow(_indexer(frequent, t), _INDEX)
                .repartition("key").sortWithinPartitions("key", "pos", "node")
                .mapInArrow(_led, _LED), "led", tokens)         # a set has no more keys than tokens
    led_rows = led.count()

    proposed = saved(led.filter((F.col("node") != F.col("l_node")) & _bounds("", "l_", num, den))
                     .select(F.col("node").alias("a"), F.col("l_node").alias("b")).distinct(), "proposed", led_rows)
    links = _verified(texts, proposed, num, den, "links")

    # rows that are not in their leader's component: their pairs between components
    parts = components(links, links.count())
    own = parts.select(F.col("node").alias("own_node"), F.col("component").alias("own_part"))
    lead = parts.select(F.col("node").alias("lead_node"), F.col("component").alias("lead_part"))
    labelled = (led.join(_maybe_broadcast(own), F.col("node") == F.col("own_node"), "left")
                .join(_maybe_broadcast(lead), F.col("l_node") == F.col("lead_node"), "left")
                .select("key", "node", "n", "pos", "rank", F.coalesce("own_part", "node").alias("part"),
                        F.coalesce("lead_part", "l_node").alias("lead")))
    labelled = saved(labelled, "labelled")
    ends = saved(labelled.filter("part <> lead")
                 .select("key", *[F.col(c).alias(f"x_{c}") for c in ("node", "n", "pos", "rank", "part")]), "ends")
    crowded = saved(ends.groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > CROWD).select("key"),
                    "crowded", led_rows)
    # a pair between components has at least one end outside the leader's component
    between = (F.col("part") != F.col("x_part")) & _bounds("", "x_", num, den)
    if crowded.isEmpty():
        pairs = labelled.join(ends, "key").filter(between).select(*_pair("node", "x_node"))
    else:
        few = ends.join(_maybe_broadcast(crowded), "key", "left_anti")
        many = _sketched(texts, labelled.join(_maybe_broadcast(crowded), "key", "left_semi"))
        theirs = many.filter("part <> lead").select(
            "key", *[F.col(c).alias(f"x_{c}") for c in ("node", "n", "pos", "rank", "part", *_BITS)])
        pairs = (labelled.join(few, "key").filter(between).select(*_pair("node", "x_node"))
                 .unionByName(many.join(theirs, "key").filter(between & _alike("", "x_", num, den))
                              .select(*_pair("node", "x_node"))))
    more = saved(pairs.distinct().join(proposed.select(*_pair("a", "b")).distinct(), ["a", "b"], "left_anti"),
                 "more", led_rows)
    # few of them reach the similarity, so short tokens go first
    likely = _verified(texts, more, num, den, "likely", short=True)
    if not likely.isEmpty():
        links = links.unionByName(_verified(texts, likely, num, den, "links"))
    return members, links


def _maybe_broadcast(ids: DataFrame) -> DataFrame:
    """Broadcast a written table of ids while it is small, else leave it to a sort-merge join."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def ngram_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     num: int = 75, den: int = 100) -> DataFrame:
    """``(doc_id, n_shingles, component_id, class_id)``, one row per input row.

    Null, empty and wordless texts have the empty set: 0 shingles, linked with
    nothing, own component. Texts of one to four words are one shingle. Equal
    sets always link. Repeated rows give repeated result rows; rows with one id
    but different texts are one node with the links of all of them. A row with a
    null id links only by an equal set, and has a null component if no row with
    an id has that set. An empty table gives no rows.
    """
    members, links = ngram_links(docs, id_col, text_col, num, den)
    rows = members.count()
    parts = saved(components(links, links.count()).withColumnRenamed("node", "class_id"), "parts", rows)
    own = members.join(parts, "class_id", "left")
    return in_few(own.select("doc_id", "n_shingles", F.coalesce("component", "class_id").alias("component_id"), "class_id"), rows)
