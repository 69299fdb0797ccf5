"""License scans: exact set-similarity join of text blocks with templates of licenses.

A template is the set of its words, a text block a run of words of the text. Blocks
are found that hold at least four fifths of a template's words. All words are ordered
by the number of documents that hold them, rarest first. A block that meets the
threshold has one of the template's rarest words (prefix filter), enough words of any
template (length filter), and enough of them from the first common one on (positional
filter); what is left is intersected exactly.

Of every text the places of the templates' words are written once; their frequencies
come from there, and the search reads them.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, written
from .terms import Vocabulary, lists, terms_of

#: Phrases that are searched for as they stand, and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Public license notices and their labels.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    (
        "apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in"
        " compliance with the License. You may obtain a copy of the License at",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met",
    ),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    ("cc0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation",
    ),
    ("mit", "Released under the MIT License"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files, to deal in the Software without restriction",
    ),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
)

#: A block has so many of five words of a template.
SHARE = (4, 5)

_FOUND = "array<struct<label string, first long, last long, overlap int, size int>>"
_PLACES = "array<struct<label string, first long>>"


def stride_of(n: int) -> int:
    """Blocks of a template of ``n`` words are twice that long, a power of two, and begin every half of it."""
    return max(4, 1 << (max(1, n) - 1).bit_length())


@dataclass(frozen=True)
class Template:
    label: str
    stride: int
    order: tuple[int, ...]  # numbers of its words, rarest first
    least: int  # words of it that a block has to have

    @property
    def prefix(self) -> tuple[int, ...]:
        return self.order[: len(self.order) - self.least + 1]


class Scanner:
    """Finds blocks and phrases among the places of known words; ``rank`` orders these from the rarest on."""

    def __init__(self, vocabulary: Mapping[bytes, int], rank: Sequence[int], templates: Sequence[tuple[str, str]], phrases: Mapping[str, str]):
        self.rank = np.asarray(rank, np.int64)
        self.phrases = [([vocabulary[w] for w in terms_of(p)], label) for p, label in phrases.items()]
        self.templates = []
        for label, text in templates:
            words = [vocabulary[w] for w in terms_of(text)]
            order = tuple(sorted(set(words), key=lambda w: rank[w]))
            self.templates.append(Template(label, stride_of(len(words)), order, -(-SHARE[0] * len(order) // SHARE[1])))
        self.by_word: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for number, t in enumerate(self.templates):
            for place, word in enumerate(t.prefix):
                self.by_word.setdefault((t.stride, word), []).append((number, place))
        strides = sorted({t.stride for t in self.templates})
        self.rare = {stride: np.array([w for s, w in self.by_word if s == stride]) for stride in strides}

    def places(self, at: np.ndarray, word: np.ndarray) -> list[tuple[str, int]]:
        """The label and first word of each place where a phrase's words stand one after the other."""
        found = []
        for words, label in self.phrases:
            n = len(words)
            if len(at) < n:
                continue
            starts = len(at) - n + 1
            good = np.ones(starts, bool)
            for k, w in enumerate(words):
                good &= (word[k : k + starts] == w) & (at[k : k + starts] - at[:starts] == k)
            found += [(label, int(x)) for x in at[:starts][good]]
        return found

    def blocks(self, at: np.ndarray, word: np.ndarray, n_words: int) -> list[tuple[str, int, int, int, int]]:
        """(label, first, last, overlap, size) of each block and template of at least the wanted share."""
        found = []
        for stride, words in self.rare.items():
            rare = np.flatnonzero(np.isin(word, words))
            inside = at[rare] // stride
            for k in np.unique(np.concatenate([inside, inside[inside > 0] - 1])).tolist():
                a, b = np.searchsorted(at, [k * stride, (k + 2) * stride])
                here = np.unique(word[a:b])
                own = here[np.argsort(self.rank[here])].tolist()  # the block's known words, rarest first
                found += [
                    (t.label, k * stride, min(n_words, (k + 2) * stride) - 1, overlap, len(t.order))
                    for t, overlap in self._matches(stride, own)
                ]
        return found

    def _matches(self, stride: int, own: list[int]) -> Iterator[tuple[Template, int]]:
        looked = set()
        for j, word in enumerate(own):
            for number, i in self.by_word.get((stride, word), ()):
                t = self.templates[number]
                if number in looked or len(own) < t.least:
                    continue  # the first common word decides; the length filter
                looked.add(number)
                if 1 + min(len(t.order) - i - 1, len(own) - j - 1) < t.least:
                    continue  # the positional filter
                overlap = len(set(t.order) & set(own))
                if overlap >= t.least:
                    yield t, overlap


def _known_places(docs: DataFrame, words: Sequence[bytes], id_col: str, text_col: str) -> DataFrame:
    """(id, n_words, at, word), written: each text's number of words, and the place and number of those that are known."""
    sent = docs.sparkSession.sparkContext.broadcast(Vocabulary(words))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            for first, last, data, offsets in blocks(batch.column(1), 1 << 22):
                word, place = known.find(data, offsets)
                there = np.flatnonzero(word >= 0)
                ends = np.searchsorted(there, place)
                at = there - np.repeat(place[:-1], np.diff(ends))
                columns = [batch.column(0).slice(first, last - first), pa.array(np.diff(place), pa.int64()), lists(at, ends), lists(word[there], ends)]
                yield pa.RecordBatch.from_arrays(columns, ["id", "n_words", "at", "word"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return written(rows.mapInArrow(find, "id long, n_words long, at array<int>, word array<int>"), "license-words")


def scan(
    docs: DataFrame,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    phrases: Mapping[str, str] = PHRASES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, n_words, places, blocks) for each row of ``docs``.

    Words are runs of digits, a-z (A-Z lower-cased) and all that is not ASCII.
    ``places`` has (label, first) of each place where a phrase's words stand one after
    the other; ``first`` is its first word's place, from 0 on. ``blocks`` has (label,
    first, last, overlap, size) of each text block that holds at least four fifths of
    a template's ``size`` distinct words, namely ``overlap`` of them. The blocks for a
    template of up to m words, m being 4, 8, 16, ..., are the words from 0, m, 2 m, ... on,
    2 m of them or as many as there are; so wherever m words in a row hold enough, a
    block does. Null and empty texts have no words; whole texts are looked at; repeated
    rows are treated alike; an empty table gives an empty result; other columns are not
    looked at. ``templates`` and ``phrases`` go to every task.
    """
    words: dict[bytes, int] = {}
    for text in (*phrases, *(t for _, t in templates)):
        for w in terms_of(text):
            words.setdefault(w, len(words))
    rows = _known_places(docs, list(words), id_col, text_col)
    held = rows.select(F.explode(F.array_distinct("word")).alias("word")).groupBy("word").agg(F.count("*").alias("df"))
    df = {r["word"]: r["df"] for r in held.collect()}  # one number for each word of a template
    rank = np.empty(len(words), np.int64)
    rank[sorted(range(len(words)), key=lambda w: (df.get(w, 0), w))] = np.arange(len(words))
    sent = docs.sparkSession.sparkContext.broadcast((words, rank.tolist(), tuple(templates), dict(phrases)))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(*sent.value)
        place = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64())]))
        block = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("overlap", pa.int32()), ("size", pa.int32())]))
        for batch in batches:
            n_words = batch.column(1).to_pylist()
            at, word = (np.asarray(c.flatten()).astype(np.int64) for c in batch.columns[2:])
            ends = np.concatenate([[0], np.cumsum(np.asarray(batch.column(2).value_lengths()))]).astype(np.int64)
            own = [(at[a:b], word[a:b]) for a, b in zip(ends, ends[1:])]
            places = [[{"label": x, "first": k} for x, k in scanner.places(*o)] for o in own]
            found = [
                [{"label": x, "first": a, "last": b, "overlap": k, "size": m} for x, a, b, k, m in scanner.blocks(*o, n)] for o, n in zip(own, n_words)
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(places, place), pa.array(found, block)], ["id", "n_words", "places", "blocks"]
            )

    return rows.mapInArrow(look, f"id long, n_words long, places {_PLACES}, blocks {_FOUND}")


def with_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score) for each row of ``docs``, from :func:`scan`.

    ``n_base`` counts the phrases' places, ``first_word`` and ``last_word`` are the
    least and greatest of them. ``labels`` has those of phrases and of blocks, distinct,
    sorted, with commas; empty if there are none. ``score`` is 1 where a phrase stands,
    else the greatest share of a template that a block holds, else 0.
    """
    got = scan(docs, id_col=id_col, text_col=text_col, **options)
    base = F.array_distinct(F.col("places.label"))
    every = F.array_distinct(F.concat(F.col("places.label"), F.col("blocks.label")))
    share = F.array_max(F.transform("blocks", lambda b: b["overlap"].cast("double") / b["size"]))
    return got.select(
        "id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(F.col("places.first")).alias("first_word"),
        F.array_max(F.col("places.first")).alias("last_word"),
        F.array_join(F.sort_array(base), ",").alias("base_labels"),
        F.array_join(F.sort_array(every), ",").alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce(share, F.lit(0.0))).alias("score"),
    )
