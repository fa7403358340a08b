"""Licence scan by a positional index of rare words.

A licence template is a short notice in words, with mandatory key phrases at given places. The index holds, for every word
of a key phrase, its postings: template, phrase, and place in the phrase. A word's rarity is its inverse document
frequency over all documents. A file is looked up by the rarest word of each phrase: its places in the file, less the
word's place in the phrase, are where the phrase may begin. The postings of the phrase's other words are intersected with
these by relative position, rarest first, until nothing is left or every word has agreed, which verifies the phrase. A
template is found where all its key phrases stand at their distances from the first one, give or take ``SLACK`` words.

Which word is looked up depends on the frequencies; what is found does not. The score of a place is the share of the
template's words, weighted by rarity, that stand in order in the file around it; a document's score is its best one.

Lower case is A-Z only, and words are runs of ASCII letters and digits and of all other characters beyond ASCII. Null and
empty texts have no words and score 0. Every row is scanned for itself, so repeated rows and ids are alike and other
columns play no part. A text that is only a number of words long is scanned whole; nothing is cut.
"""

from __future__ import annotations

import math
import re
import string
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLACK = 8
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)

# Phrases and labels of the contract, each a template of its own.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Notices by which licences are commonly stated. A slash begins and ends a mandatory key phrase.
NOTICES = [
    ("mit", "/permission is hereby granted free of charge to any person obtaining a copy/ of this software and associated documentation files "
     "the software to deal in the software without restriction /including without limitation the rights to use copy modify merge publish/ "
     "distribute sublicense and or sell copies of the software"),
    ("mit", "/spdx license identifier mit/"),
    ("apache", "/licensed under the apache license/ version 2 0 the license you may not use this file except in compliance with the license"),
    ("apache", "/unless required by applicable law or agreed to in writing/ software distributed under the license is distributed on an as is "
     "basis /without warranties or conditions of any kind/"),
    ("apache", "/spdx license identifier apache 2 0/"),
    ("gpl", "/this program is free software/ you can redistribute it and or modify it under the terms of the /gnu general public license/ as "
     "published by the free software foundation"),
    ("gpl", "/gnu gpl/"),
    ("gpl", "/spdx license identifier gpl/"),
    ("lgpl", "/gnu lesser general public license/"),
    ("lgpl", "/spdx license identifier lgpl/"),
    ("agpl", "/gnu affero general public license/"),
    ("agpl", "/spdx license identifier agpl/"),
    ("bsd", "/redistribution and use in source and binary forms with or without modification are permitted/ provided that the following "
     "conditions are met"),
    ("bsd", "/bsd license/"),
    ("bsd", "/spdx license identifier bsd/"),
    ("isc", "/permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted/"),
    ("isc", "/spdx license identifier isc/"),
    ("mpl", "/mozilla public license/"),
    ("mpl", "/spdx license identifier mpl/"),
    ("epl", "/eclipse public license/"),
    ("bsl", "/boost software license/ version 1 0"),
    ("zlib", "/this software is provided as is without any express or implied warranty/ in no event will the authors be held liable for any "
     "damages"),
    ("unlicense", "/this is free and unencumbered software released into the public domain/"),
    ("wtfpl", "/do what the fuck you want to public license/"),
    ("cc", "/licensed under cc by/"),
    ("cc", "/creative commons attribution/"),
    ("cc", "/licensed under a creative commons/"),
    ("cc0", "/cc0 1 0 universal/"),
    ("cc0", "/spdx license identifier cc0/"),
    ("proprietary", "/all rights reserved/ /unauthorized copying of this file/ via any medium is strictly prohibited"),
]


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    phrases: tuple[tuple[int, tuple[str, ...]], ...]  # where a key phrase begins in words, and its words
    base: bool = False


def template(label: str, notice: str, base: bool = False) -> Template:
    words: list[str] = []
    phrases = []
    for k, part in enumerate(notice.split("/")):
        own = tuple(WORD.findall(part))
        if k % 2:
            phrases.append((len(words), own))
        words += own
    return Template(label, tuple(words), tuple(phrases), base)


TEMPLATES = [template(label, f"/{phrase}/", True) for phrase, label in BASE.items()] + [template(*notice) for notice in NOTICES]


@dataclass(frozen=True)
class Place:
    """A template in a text: words ``first`` to ``last`` (inclusive)."""

    label: str
    first: int
    last: int
    base: bool
    score: float


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(_LOWER))


@dataclass(frozen=True)
class Index:
    """Templates and how rare their words are."""

    templates: list[Template]
    idf: dict[str, float]

    @cached_property
    def vocabulary(self) -> frozenset[str]:
        return frozenset(w for t in self.templates for w in t.words)

    @cached_property
    def phrases(self) -> dict[tuple[str, ...], list[tuple[str, int]]]:
        """The postings of every key phrase: its words and their places in it, rarest first."""
        every = {p for t in self.templates for _, p in t.phrases}
        return {p: sorted(((w, k) for k, w in enumerate(p)), key=lambda x: (-self.idf.get(x[0], 0.0), x)) for p in every}

    @cached_property
    def by_rarest(self) -> dict[str, list[tuple[str, ...]]]:
        out = defaultdict(list)
        for phrase, postings in sorted(self.phrases.items()):
            out[postings[0][0]].append(phrase)
        return dict(out)

    def starts(self, phrase: tuple[str, ...], places: dict[str, list[int]]) -> list[int]:
        """Where the phrase's words stand one after the other."""
        postings = self.phrases[phrase]
        (rarest, at), rest = postings[0], postings[1:]
        found = [p - at for p in places.get(rarest, ()) if p >= at]
        for word, k in rest:
            if not found:
                break
            own = set(places.get(word, ()))
            found = [s for s in found if s + k in own]
        return found

    def scan(self, words: list[str]) -> list[Place]:
        known = self.vocabulary
        places: dict[str, list[int]] = defaultdict(list)
        for k, w in enumerate(words):
            if w in known:
                places[w].append(k)
        starts = {p: s for w in places if w in self.by_rarest for p in self.by_rarest[w] if (s := self.starts(p, places))}
        return [p for t in self.templates if all(phrase in starts for _, phrase in t.phrases) for p in self._places(t, starts, places)]

    def _places(self, t: Template, starts: dict, places: dict[str, list[int]]) -> Iterator[Place]:
        (origin, head), rest = t.phrases[0], t.phrases[1:]
        for s in starts[head]:
            last = s + len(head) - 1
            for at, phrase in rest:
                due, own = s + at - origin, starts[phrase]
                k = bisect_left(own, due - SLACK)
                if k == len(own) or own[k] > due + SLACK:
                    break
                last = max(last, own[k] + len(phrase) - 1)
            else:
                yield Place(t.label, s, last, t.base, self._share(t, s - origin, places))

    def _share(self, t: Template, begin: int, places: dict[str, list[int]]) -> float:
        """The weight of the template's words that stand in order, near where they are due."""
        total = got = 0.0
        behind = begin - SLACK - 1
        for k, w in enumerate(t.words):
            weight = 1.0 + self.idf.get(w, 0.0)
            total += weight
            own = places.get(w, ())
            i = bisect_left(own, max(behind + 1, begin + k - SLACK))
            if i < len(own) and own[i] <= begin + k + SLACK:
                got += weight
                behind = own[i]
        return got / total


# ---- Spark


def document_frequencies(docs: DataFrame, vocabulary: frozenset[str]) -> tuple[int, dict[str, int]]:
    """How many documents there are, and how many hold each word of the vocabulary, which is of fixed size."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str | None, int] = defaultdict(int)
        for batch in batches:
            held[None] += batch.num_rows
            for text in batch.column(0):
                for w in vocabulary.intersection(words_of(text.as_py())):
                    held[w] += 1
        columns = [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["word", "n"])

    counts = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    found = {r["word"]: r["n"] for r in counts.collect()}  # bounded: the words of the templates
    return found.pop(None, 0), found


def index_for(docs: DataFrame, templates: list[Template] | None = None) -> Index:
    """The index of the templates with the rarity that their words have in ``docs``."""
    templates = TEMPLATES if templates is None else templates
    total, held = document_frequencies(docs, Index(templates, {}).vocabulary)
    idf = {w: math.log((total + 1) / (held.get(w, 0) + 1)) for t in templates for w in t.words}
    return Index(templates, idf)


PLACE = pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("base", pa.bool_()), ("score", pa.float64())])


def scan_licenses(docs: DataFrame, keep: list[str] | None = None, index: Index | None = None) -> DataFrame:
    """Columns of ``docs`` (all, or ``keep``) as struct ``row``, n_words, and ``places``: label, first, last, base, score."""
    keep = docs.columns if keep is None else keep
    index = index_for(docs) if index is None else index

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, places = [], []
            for text in batch.column(1):
                words = words_of(text.as_py())
                counts.append(len(words))
                places.append([vars(p) for p in index.scan(words)])
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(places, pa.list_(PLACE))]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "n_words", "places"])

    packed = docs.select(F.struct(*[docs[c] for c in keep]).alias("row"), docs["text"].cast("string").alias("text"))
    row_type = packed.schema["row"].dataType.simpleString()
    schema = f"row {row_type}, n_words bigint, places array<struct<label:string,`first`:bigint,`last`:bigint,base:boolean,score:double>>"
    return packed.mapInArrow(scan, schema)


def _labels(places: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")


def document_licenses(docs: DataFrame) -> DataFrame:
    """The result of the query: the places of the base phrases, the labels of these and of all templates, and the score."""
    found = scan_licenses(docs, keep=["doc_id"])
    base = F.filter("places", lambda p: p["base"])
    begins = F.transform(base, lambda p: p["first"])
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(begins).alias("first_word"),
        F.array_max(begins).alias("last_word"),
        _labels(base).alias("base_labels"),
        _labels(F.col("places")).alias("labels"),
        F.coalesce(F.array_max(F.transform("places", lambda p: p["score"])), F.lit(0.0)).alias("score"),
    )
