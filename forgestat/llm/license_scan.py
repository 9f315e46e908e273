"""Operator 5: licence scan by a positional rare-token index (DataFrame functions only).

A template is a licence passage with its label: a run of words of which some
runs are mandatory key phrases, each at its offset (a bare name such as ``mit
license`` is one key phrase and nothing else). The index has postings (template,
offset) for two words of highest IDF of every template: one of its first key
phrase and one of the others (of a single phrase: its two rarest). A file's words
are looked up there: a posting at offset k met at place i proposes that the
template starts at i - k. The proposals of both words are intersected, allowing
for ``SLACK`` words put in or left out between key phrases, and what is left is
verified by comparing all key phrases word for word.

Every text is cut into words once: the first pass keeps the number of words, the
licence words that it holds (for the IDF over all documents) and, of texts that
hold all words of a template's key phrases, the words themselves. No other text
can hold a template.
"""

from __future__ import annotations

import math
import re
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgestat.llm.common import documents_of, saved

# The phrases that must be found, with their labels.
BASE = (("gnu general public license", "gpl"), ("apache license", "apache"),
        ("cc by", "cc-by"), ("mit license", "mit"))
# Phrases added here: further names and the tags of source files.
ADDED = (("gnu lesser general public license", "lgpl"), ("mozilla public license", "mpl"),
         ("bsd license", "bsd"), ("isc license", "isc"), ("creative commons attribution", "cc-by"),
         ("spdx license identifier mit", "mit"), ("spdx license identifier apache 2 0", "apache"),
         ("spdx license identifier gpl", "gpl"), ("spdx license identifier lgpl", "lgpl"),
         ("spdx license identifier mpl 2 0", "mpl"), ("spdx license identifier bsd", "bsd"),
         ("spdx license identifier isc", "isc"))
# Notices of public licences, key phrases in brackets.
PASSAGES = (
    ("[permission is hereby granted free of charge to any person obtaining a copy] of this software and associated "
     "documentation files the software [to deal in the software without restriction]", "mit"),
    ("[redistribution and use in source and binary forms with or without modification are permitted] provided that the "
     "following conditions are met [redistributions of source code must retain the above copyright notice]", "bsd"),
    ("[permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
     "granted] provided that the above copyright notice and this permission notice [appear in all copies]", "isc"),
    ("[you may not use this file except in compliance with the license] you may obtain a copy of the license at http www "
     "apache org licenses license 2 0 [unless required by applicable law or agreed to in writing software]", "apache"),
    ("[this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
     "license] as [published by the free software foundation]", "gpl"),
    ("[this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general "
     "public license] as [published by the free software foundation]", "lgpl"),
    ("[this source code form is subject to the terms of the mozilla public license] v 2 0 [if a copy of the mpl was not "
     "distributed with this file]", "mpl"),
    ("[this is free and unencumbered software released into the public domain] [anyone is free to copy modify publish "
     "use compile sell or distribute this software]", "unlicense"),
    ("[this software is provided as is without any express or implied warranty] in no event will the authors be held "
     "liable for any damages arising from the use of this software [permission is granted to anyone to use this software "
     "for any purpose]", "zlib"),
    ("[permission is hereby granted free of charge to any person or organization obtaining a copy] of the software and "
     "[accompanying documentation covered by this license]", "bsl"))

#: A further key phrase may stand this many words before or after its offset.
SLACK = 8

#: Words after lower-casing A-Z.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _template(marked: str) -> list[tuple[str, int]]:
    """(key phrase, offset) of a passage; the first one stands at its start."""
    parts, at = [], 0
    for key, between in re.findall(r"\[([^]]*)\]([^[]*)", marked):
        parts.append((key, at))
        at += len(key.split()) + len(between.split())
    return parts


#: (key phrases with offsets, label) of every template, the base ones first.
TEMPLATES = [([(phrase, 0)], label) for phrase, label in BASE + ADDED] + [(_template(p), label) for p, label in PASSAGES]


def _words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))


def _key_words(template: list[tuple[str, int]]) -> list[tuple[str, int, int]]:
    """(word, offset, key phrase number) of a template's key phrases."""
    return [(w, at + j, n) for n, (phrase, at) in enumerate(template) for j, w in enumerate(phrase.split())]


def _cut(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(doc_id, n_words, present, words)`` of every row, written; ``words`` is
    null unless all words of some template's key phrases are present."""
    needs = [sorted({w for w, _, _ in _key_words(t)}) for t, _ in TEMPLATES]
    names = sorted({w for need in needs for w in need})
    text = F.coalesce(F.col("text"), F.lit(""))
    whole = F.array(*[F.array(*map(F.lit, need)) for need in needs])
    held = F.exists(whole, lambda need: F.size(F.array_except(need, F.col("present"))) == 0)
    # lower() agrees with A-Z lowering on ASCII words and keeps their number; it may
    # make such words of other letters, so what is compared is lowered in A-Z only
    return saved(documents_of(docs, id_col, text_col)
                 .withColumn("all", _words(F.lower(text)))
                 .select("doc_id", "text", F.size("all").cast("long").alias("n_words"),
                         F.array_distinct(F.filter("all", lambda w: w.isin(names))).alias("present"))
                 .select("doc_id", "n_words", "present", F.when(
                     held, _words(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))).alias("words")),
                 "licence-words")


def word_idf(present: DataFrame) -> dict[str, float]:
    """IDF over all documents of every word of the key phrases (a fixed list), from ``present``."""
    n = present.count()
    rows = present.select(F.explode("present").alias("w")).groupBy("w").count().collect()
    counts = {r["w"]: r["count"] for r in rows}
    return {w: math.log((1 + n) / (1 + counts.get(w, 0))) for t, _ in TEMPLATES for w, _, _ in _key_words(t)}


def _anchors(template: list[tuple[str, int]], idf: dict[str, float]) -> tuple[tuple[str, int], tuple[str, int]]:
    """The two indexed (word, offset) of a template: of highest IDF in the first
    key phrase and in the others; of a single one its two rarest words."""
    # ties in IDF: the word that stands later
    order = sorted(_key_words(template), key=lambda x: (-idf[x[0]], -x[1]))
    first = next(x for x in order if x[2] == 0)
    other = next(x for x in order if (x[2] > 0 if len(template) > 1 else x != first))
    return first[:2], other[:2]


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score, places)``, one row per input row. ``places`` lists (template number,
    start word) of every verified template in this order; ``score`` is
    1 - 2 ** -(their number).

    A template is found where its first key phrase stands and every other key
    phrase stands within ``SLACK`` words of its offset from there. Null and empty
    texts have no words and no places; labels are then empty strings and
    ``first_word`` / ``last_word`` null. Ids are given back as they are; repeated
    rows give repeated result rows; an empty table gives no rows.
    """
    cut = _cut(docs, id_col, text_col)
    idf = word_idf(cut.select("present"))
    postings: tuple[dict, dict] = ({}, {})
    for k, (template, _) in enumerate(TEMPLATES):
        for posting, (word, offset) in zip(postings, _anchors(template, idf)):
            posting.setdefault(word, []).append((k, offset, 0 if len(template) == 1 else SLACK))

    def proposed(rank: int) -> Column:
        index = F.create_map(*[x for w, p in postings[rank].items() for x in (F.lit(w), F.array(*[
            F.struct(F.lit(k).alias("k"), F.lit(o).alias("o"), F.lit(s if rank else 0).alias("s")) for k, o, s in p]))])
        here = F.filter(F.col("hits"), lambda x: x["w"].isin(list(postings[rank])))
        return F.flatten(F.transform(here, lambda x: F.flatten(F.transform(
            F.element_at(index, x["w"]), lambda p: F.transform(F.sequence(-p["s"], p["s"]), lambda d: F.struct(
                p["k"].alias("k"), (x["i"] - p["o"] + d).alias("at")))))))
    names = sorted(set(postings[0]) | set(postings[1]))
    keys = F.array(*[F.array(*[F.struct(
        F.lit(phrase).alias("phrase"), F.lit(len(phrase.split())).alias("n"), F.lit(at).alias("o"),
        F.lit(SLACK if j else 0).alias("s")) for j, (phrase, at) in enumerate(template)]) for template, _ in TEMPLATES])
    labels = F.array(*[F.lit(label) for _, label in TEMPLATES])

    def verified(c: Column) -> Column:
        def stands(q: Column, key: Column) -> Column:
            run = F.slice(F.col("words"), F.greatest(q, F.lit(0)) + 1, key["n"])
            return (q >= 0) & (F.array_join(run, " ") == key["phrase"])
        return F.forall(F.element_at(keys, c["k"] + 1), lambda key: F.exists(
            F.sequence(c["at"] + key["o"] - key["s"], c["at"] + key["o"] + key["s"]), lambda q: stands(q, key)))

    def names_of(places: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(
            F.transform(places, lambda c: F.element_at(labels, c["k"] + 1)))), ",")
    hits = F.filter(F.transform("words", lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda x: x["w"].isin(names))
    starts = F.transform(F.col("base"), lambda c: c["at"].cast("long"))
    return (cut.withColumn("hits", hits)
            .withColumn("places", F.array_intersect(proposed(0), proposed(1)))
            .withColumn("places", F.coalesce(F.array_sort(F.filter("places", verified)), F.expr(
                "cast(array() as array<struct<k: int, at: int>>)")))
            .withColumn("base", F.filter(F.col("places"), lambda c: c["k"] < len(BASE)))
            .select("doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
                    F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
                    names_of(F.col("base")).alias("base_labels"), names_of(F.col("places")).alias("labels"),
                    (1 - F.pow(F.lit(0.5), F.size("places"))).alias("score"), "places"))


def oracle_sql() -> str:
    """The contract's columns in DuckDB SQL, without the index."""
    rows = ", ".join(f"({k}, {j}, {len(template)}, {at}, '{phrase}', '{label}', {len(phrase.split())}, '{phrase.split()[0]}')"
                     for k, (template, label) in enumerate(TEMPLATES) for j, (phrase, at) in enumerate(template))
    return f"""
with words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
                                    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from documents),
phrases(k, j, m, o, phrase, label, n, head) as (values {rows}),
spots as (
  select d.doc_id, d.i - 1 - p.o as start, p.k, p.j, p.m, p.label
  from (select doc_id, w, unnest(range(1, len(w) + 1)) as i from words) d
  join phrases p on d.w[d.i] = p.head
  where array_to_string(d.w[d.i : d.i + p.n - 1], ' ') = p.phrase),
places as (
  select f.doc_id, f.start, f.k, f.label
  from spots f left join spots s
    on s.doc_id = f.doc_id and s.k = f.k and s.j > 0 and s.start between f.start - {SLACK} and f.start + {SLACK}
  where f.j = 0 group by f.doc_id, f.start, f.k, f.label, f.m having count(distinct s.j) = f.m - 1),
found as (
  select doc_id, count(*) filter (where k < {len(BASE)}) as n_base, min(start) filter (where k < {len(BASE)}) as first_word,
         max(start) filter (where k < {len(BASE)}) as last_word, count(*) as n
  from places group by doc_id),
base_names as (select doc_id, string_agg(label, ',' order by label) as s
               from (select distinct doc_id, label from places where k < {len(BASE)}) group by doc_id),
all_names as (select doc_id, string_agg(label, ',' order by label) as s
              from (select distinct doc_id, label from places) group by doc_id)
select words.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_base, 0) as bigint) as n_base,
       cast(first_word as bigint) as first_word, cast(last_word as bigint) as last_word,
       coalesce(base_names.s, '') as base_labels, coalesce(all_names.s, '') as labels,
       1 - pow(0.5::double, coalesce(n, 0)) as score
from words left join found using (doc_id) left join base_names using (doc_id) left join all_names using (doc_id)
"""
