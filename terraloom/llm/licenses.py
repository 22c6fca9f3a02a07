"""License scans with a positional rare-token index.

Templates are short, characteristic passages of license texts and notices. Words are
weighed by how few documents of the corpus have them; each template is indexed by its
rarest words and their positions. A file looks up its words in that index; postings that
agree on where the template would begin make a candidate, which counts only if the
template's mandatory key phrases stand there word for word.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textops

#: Words by which each template is indexed, and how many of them have to agree (all, if a template has fewer).
RARE_WORDS = 8
AGREE = 2
#: Words that may be missing or added between two index words of one occurrence.
SLACK = 8
#: Least share of a template's weight that has to stand in place.
LEAST_SHARE = 0.6

# Phrases that are counted wherever they stand, and the label of each.
PHRASES = (
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
)

# Label, template, mandatory key phrases.
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction",
     ("permission is hereby granted free of charge", "without restriction")),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
     ("apache license version 2 0", "except in compliance with the license")),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license "
     "as published by the free software foundation",
     ("gnu general public license", "free software foundation")),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    ("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    ("mit-notice", "released under the mit license", ("released under the mit license",)),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    ("cc-by-4.0", "licensed under a creative commons attribution 4 0 international license", ("creative commons attribution 4 0 international",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the "
     "following conditions are met",
     ("redistribution and use in source and binary forms", "following conditions are met")),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
     ("permission to use copy modify", "with or without fee is hereby granted")),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license v 2 0",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software", "public domain")),
)


@dataclass
class LicenseIndex:
    """Templates and phrases as word numbers, word weights, and the postings of index words.

    Its size is fixed by the templates.
    """

    vocabulary: np.ndarray  # sorted word hashes
    weight: np.ndarray
    labels: list[str]
    texts: list[np.ndarray]
    keys: list[list[np.ndarray]]
    base: list[tuple[np.ndarray, str]]
    postings: dict[int, list[tuple[int, int]]]
    need: np.ndarray


def _hashes(text: str) -> list[int]:
    return [textops.text_hash(w) for w in text.split(" ")]


def vocabulary(templates=TEMPLATES, phrases=PHRASES) -> np.ndarray:
    """Sorted hashes of all words of templates and phrases."""
    words = {h for _, text, keys in templates for part in (text, *keys) for h in _hashes(part)}
    return np.array(sorted(words | {h for text, _ in phrases for h in _hashes(text)}), np.uint64)


def _numbers(known: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Place of each hash in the vocabulary, or -1."""
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return np.where(known[at] == hashes, at, -1)


def document_counts(documents: DataFrame, known: np.ndarray) -> tuple[np.ndarray, int]:
    """In how many documents each license word stands, and how many documents there are.

    Tasks send one row per license word they met; the sums are as many rows as the
    vocabulary has words.
    """

    def run(batches):
        counts, rows = np.zeros(len(known) + 1, np.int64), 0
        for batch in batches:
            rows += batch.num_rows
            for part in textops.slices(batch.column("text")):
                _, _, docs, hashes = textops.words(part)
                number = _numbers(known, hashes)
                real = number >= 0
                pairs = np.unique(docs[real] * len(known) + number[real])
                counts[:-1] += np.bincount(pairs % len(known), minlength=len(known))
        counts[-1] = rows
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(counts[at], pa.int64())], names=["word", "n"])

    found = documents.select("text").mapInArrow(run, "word int, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(len(known) + 1, np.int64)
    for row in found:
        counts[row.word] = row.n
    return counts[:-1], int(counts[-1])


def build_index(counts: np.ndarray, rows: int, templates=TEMPLATES, phrases=PHRASES) -> LicenseIndex:
    known = vocabulary(templates, phrases)
    weight = np.log((rows + 1.0) / (counts + 1.0)) + 1.0

    def numbers(text: str) -> np.ndarray:
        return _numbers(known, np.array(_hashes(text), np.uint64))

    texts = [numbers(text) for _, text, _ in templates]
    postings: dict[int, list[tuple[int, int]]] = {}
    need = []
    for t, text in enumerate(texts):
        _, first = np.unique(text, return_index=True)
        rare = sorted(sorted(first), key=lambda k: -weight[text[k]])[:RARE_WORDS]
        need.append(min(AGREE, len(rare)))
        for at in np.flatnonzero(np.isin(text, text[rare])):
            postings.setdefault(int(text[at]), []).append((t, int(at)))
    return LicenseIndex(
        known, weight, [label for label, _, _ in templates], texts, [[numbers(k) for k in keys] for _, _, keys in templates],
        [(numbers(text), label) for text, label in phrases], postings, np.array(need),
    )


def _places(words: np.ndarray, docs: np.ndarray, weight: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """First words of all places where a phrase stands: the rarest word is looked up, the others follow from its position."""
    lead = int(np.argmax(weight[phrase]))
    at = np.flatnonzero(words == phrase[lead]) - lead
    at = at[(at >= 0) & (at + len(phrase) <= len(words))]
    for k, w in enumerate(phrase):
        at = at[words[at + k] == w]
    return at[docs[at] == docs[at + len(phrase) - 1]]


def scan_slice(index: LicenseIndex, part: textops.Slice) -> Iterable[tuple]:
    """Per text: words, base places, first and last of them, base labels, matches as (label, first word, last word + 1, share)."""
    _, _, docs, hashes = textops.words(part)
    n_words = np.bincount(docs, minlength=part.n)
    start_of = np.concatenate(([0], np.cumsum(n_words)))
    words = _numbers(index.vocabulary, hashes) if len(hashes) else np.zeros(0, np.int64)
    base = [(_places(words, docs, index.weight, phrase), label) for phrase, label in index.base]
    every = np.sort(np.concatenate([at for at, _ in base])) if base else np.zeros(0, np.int64)
    n_base = np.bincount(docs[every], minlength=part.n)
    edges = np.searchsorted(docs[every], np.arange(part.n + 1))
    labels: list[set[str]] = [set() for _ in range(part.n)]
    for at, label in base:
        for d in np.unique(docs[at]):
            labels[d].add(label)
    matches: list[list[tuple[str, int, int, float]]] = [[] for _ in range(part.n)]
    votes = []
    indexed = np.zeros(len(index.vocabulary) + 1, bool)  # the last place stands for words outside the vocabulary
    indexed[list(index.postings)] = True
    rare = np.flatnonzero(indexed[words])
    for word in np.unique(words[rare]):
        own = index.postings[int(word)]
        at = rare[words[rare] == word]
        for t, place in own:
            votes.append(np.stack([np.full(len(at), t), at - place, at, np.full(len(at), word)], 1))
    cast = np.concatenate(votes) if votes else np.zeros((0, 4), np.int64)
    if len(cast):
        cast = cast[np.lexsort((cast[:, 2], cast[:, 1], docs[cast[:, 2]], cast[:, 0]))]
        own = docs[cast[:, 2]]
        cut = np.append(True, (cast[1:, 0] != cast[:-1, 0]) | (own[1:] != own[:-1]) | (cast[1:, 1] - cast[:-1, 1] > SLACK))
        runs = np.append(np.flatnonzero(cut), len(cast))
        for a, b in zip(runs[:-1], runs[1:]):
            t = int(cast[a, 0])
            if b - a >= index.need[t] and len(np.unique(cast[a:b, 3])) >= index.need[t]:
                d = int(docs[cast[a, 2]])
                found = _verify(index, words, start_of[d], start_of[d + 1], t, cast[a:b, 1])
                if found:
                    matches[d].append((index.labels[t], *found))
    for d in range(part.n):
        first, last = (int(every[edges[d]] - start_of[d]), int(every[edges[d + 1] - 1] - start_of[d])) if n_base[d] else (None, None)
        yield int(n_words[d]), int(n_base[d]), first, last, sorted(labels[d]), matches[d]


def _verify(index: LicenseIndex, words: np.ndarray, low: int, high: int, t: int, offsets: np.ndarray) -> tuple[int, int, float] | None:
    """First word, last word + 1 and share of the weight in place, if all key phrases stand where the template would."""
    text = index.texts[t]
    a, b = max(low, int(offsets.min()) - SLACK), min(high, int(offsets.max()) + len(text) + SLACK)
    here = words[a:b]
    for key in index.keys[t]:
        if not len(_places(here, np.zeros(len(here), np.int64), index.weight, key)):
            return None
    have = np.isin(text, here)
    share = float(index.weight[text][have].sum() / index.weight[text].sum())
    if share < LEAST_SHARE:
        return None
    at = np.flatnonzero(np.isin(here, text)) + a
    return int(at[0] - low), int(at[-1] + 1 - low), share


def scan_licenses(documents: DataFrame) -> DataFrame:
    """All columns of ``documents`` with what the scan finds in each whole text.

    ``n_words``; ``n_base``, ``first_word`` and ``last_word`` (all places of the phrases,
    words counted from 0, null where there is none); ``base_labels`` and ``labels`` (arrays,
    distinct and sorted, the latter with the templates' labels); ``matches`` (label, first
    word, last word + 1, share of the template's weight); ``score``: the best share, 1 for a
    phrase, 0 for neither. Null counts as empty. Input columns of these names are replaced.
    """
    new = {
        "n_words": "long", "n_base": "long", "first_word": "long", "last_word": "long", "base_labels": "array<string>",
        "labels": "array<string>", "matches": "array<struct<label:string,first:long,last:long,share:double>>", "score": "double",
    }
    kept = [c for c in documents.columns if c not in new]
    schema = documents.select(*kept).schema
    for name, kind in new.items():
        schema = schema.add(name, T.DataType.fromDDL(kind))
    index = build_index(*document_counts(documents, vocabulary()))
    shared = documents.sparkSession.sparkContext.broadcast(index)
    fields = pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("share", pa.float64())])

    def run(batches):
        for batch in batches:
            rows = [row for part in textops.slices(batch.column("text")) for row in scan_slice(shared.value, part)]
            columns = list(zip(*rows)) if rows else [[]] * 6
            n_words, n_base, first, last, base, matches = columns
            labels = [sorted({*b, *(m[0] for m in own)}) for b, own in zip(base, matches)]
            score = [1.0 if b else max((m[3] for m in own), default=0.0) for b, own in zip(base, matches)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept]
                + [pa.array(x, pa.int64()) for x in (n_words, n_base, first, last)]
                + [pa.array(base, pa.list_(pa.string())), pa.array(labels, pa.list_(pa.string())),
                   pa.array([[dict(zip(("label", "first", "last", "share"), m)) for m in own] for own in matches], pa.list_(fields)),
                   pa.array(score, pa.float64())],
                names=[*kept, *new],
            )

    return documents.select(*kept).mapInArrow(run, schema)


def license_report(documents: DataFrame) -> DataFrame:
    """Per document: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``."""
    found = scan_licenses(documents.select("doc_id", "text"))
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"), "score",
    )
