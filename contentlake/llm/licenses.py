"""License scans with a positional rare-token index.

The index holds, for every word of the license templates, its postings (template,
place). Words weigh their IDF over all documents. For a template, the words of highest
IDF that together weigh more than a file may lack are its rare words: a place of the
file that matches the template well enough has at least one of them. Each rare word of
a file is looked up, its postings are turned into relative positions (place in the
file less place in the template, with some drift), and every position is scored by the
weight of the template words that stand where they should. A template counts if its
mandatory key phrases stand there too. Phrases given by the caller are found in the
same way, from their rarest word, with no word missing.

Files are read where they lie, without a shuffle; templates and weights are sent to
the tasks (their size is that of the templates, not of the corpus).
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contentlake.llm.common import ascii_lower

#: Words, on lower-cased UTF-8 bytes (bytes from 0x80 on belong to words).
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WORD_SQL = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GAP = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
PIECE = 1 << 20  # bytes of a text that are cut into words at once
DRIFT = 2  # words that may be missing or added before a template word
SCORE = 0.6  # share of a template's weight that must stand in place

# Notices of public licenses as (label, mandatory key phrases, text).
TEMPLATES = [
    ("mit", ["mit license"], "released under the mit license"),
    ("mit", ["permission is hereby granted free of charge", "the software is provided as is"],
     "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction including without limitation the "
     "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
     "persons to whom the software is furnished to do so subject to the following conditions the above copyright notice "
     "and this permission notice shall be included in all copies or substantial portions of the software the software "
     "is provided as is without warranty of any kind"),
    ("apache-2", ["apache license version 2"], "licensed under the apache license version 2 0"),
    ("apache-2", ["apache license version 2 0"],
     "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the "
     "license you may obtain a copy of the license at"),
    ("gpl-2", ["general public license", "version 2"], "this work is licensed under the gnu general public license version 2"),
    ("gpl-3", ["general public license", "version 3"], "this work is licensed under the gnu general public license version 3"),
    ("gpl-3", ["gnu general public license", "version 3"],
     "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
     "license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("gpl-2", ["gnu general public license", "version 2"],
     "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
     "license as published by the free software foundation either version 2 of the license or at your option any later version"),
    ("lgpl", ["lesser general public license"], "licensed under the gnu lesser general public license"),
    ("agpl-3", ["affero general public license"], "licensed under the gnu affero general public license version 3"),
    ("bsd", ["redistribution and use in source and binary forms"],
     "redistribution and use in source and binary forms with or without modification are permitted provided that the "
     "following conditions are met"),
    ("bsd", ["bsd license"], "released under the bsd license"),
    ("mpl-2", ["mozilla public license"],
     "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("isc", ["permission to use copy modify and or distribute this software"],
     "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("cc-by", ["creative commons attribution", "license"],
     "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa", ["cc by sa"], "licensed under cc by sa 4 0"),
    ("cc-by-nc", ["cc by nc"], "licensed under cc by nc 4 0"),
    ("cc-by-nd", ["cc by nd"], "licensed under cc by nd 4 0"),
    ("cc0", ["cc0"], "released under cc0 1 0 universal"),
    ("unlicense", ["free and unencumbered software"],
     "this is free and unencumbered software released into the public domain"),
]

SCAN = ("id {id}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels array<string>, "
        "labels array<string>, score double, matches array<struct<label:string,at:bigint,score:double>>")


def words(text: str) -> list[str]:
    return [w.decode("utf-8") for w in WORD.findall(text.encode("utf-8", "replace").lower())]


def pieces(data: bytes) -> Iterator[bytes]:
    """``data`` in pieces of about ``PIECE`` bytes that cut no word."""
    at = 0
    while at < len(data):
        end = at + PIECE
        if end < len(data):
            found = GAP.search(data, end)
            end = found.start() if found else len(data)
        yield data[at:end]
        at = end


class Index:
    """Postings of the template words, weights, rare words and key phrases."""

    def __init__(self, phrases: list[tuple[str, str]], templates: list[tuple[str, list[str], str]],
                 document_counts: dict[str, int], n_documents: int, score: float = SCORE) -> None:
        self.least = score
        spelled = dict.fromkeys(w for _, p in phrases for w in words(p))
        spelled |= dict.fromkeys(w for _, keys, t in templates for x in (t, *keys) for w in words(x))
        self.codes = {w.encode("utf-8"): i for i, w in enumerate(spelled)}
        self.idf = np.array([math.log(1 + (n_documents + 1) / (document_counts.get(w, 0) + 1)) for w in spelled])
        code = lambda text: np.array([self.codes[w.encode("utf-8")] for w in words(text)], dtype=np.int32)
        self.phrases = [(label, code(p)) for label, p in phrases]
        self.templates = [(label, [code(k) for k in keys], code(t)) for label, keys, t in templates]
        self.rare = [self._rare(t) for _, _, t in self.templates]

    def _rare(self, template: np.ndarray) -> dict[int, np.ndarray]:
        """The words of highest IDF without which a place can't score, with their postings."""
        weights = self.idf[template]
        lacking, out = (1 - self.least) * weights.sum() + 1e-9, {}
        for w in sorted(set(template.tolist()), key=lambda w: (-self.idf[w], w)):
            out[w] = np.flatnonzero(template == w)
            lacking -= weights[out[w]].sum()
            if lacking < 0:
                break
        return out

    def scan(self, text: str | None) -> tuple:
        """A file's row of ``SCAN`` without its id."""
        at, code, n = self._read(text or "")
        places = np.concatenate([np.empty(0, np.int64), *(self._phrase(p, at, code) for _, p in self.phrases)])
        base = sorted({label for label, p in self.phrases if len(self._phrase(p, at, code))})
        matches = [m for i in range(len(self.templates)) for m in self._matches(i, at, code)]
        labels = sorted({*base, *(label for label, _, _ in matches)})
        best = max([1.0] if base else [0.0, *(s for _, _, s in matches)])
        first, last = (int(places.min()), int(places.max())) if len(places) else (None, None)
        return n, len(places), first, last, base, labels, best, [{"label": a, "at": b, "score": c} for a, b, c in matches]

    def _read(self, text: str) -> tuple[np.ndarray, np.ndarray, int]:
        """Places and codes of the license words of a text, and its number of words."""
        at, code, n = [], [], 0
        for piece in pieces(text.encode("utf-8", "replace").lower()):
            found = WORD.findall(piece)
            for i, w in enumerate(found, n):
                if w in self.codes:
                    at.append(i)
                    code.append(self.codes[w])
            n += len(found)
        return np.array(at, dtype=np.int64), np.array(code, dtype=np.int32), n

    @staticmethod
    def _at(places: np.ndarray, at: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The license words at the given places, -1 where there is none."""
        i = np.minimum(np.searchsorted(at, places), max(len(at) - 1, 0))
        return np.where(at[i] == places, code[i], -1) if len(at) else np.full(np.shape(places), -1)

    def _phrase(self, phrase: np.ndarray, at: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Where the phrase stands: the places of its rarest word, then every other word by its relative position."""
        if not len(phrase):
            return np.empty(0, np.int64)
        order = np.argsort(-self.idf[phrase], kind="stable")
        starts = at[code == phrase[order[0]]] - order[0]
        for i in order[1:]:
            if not len(starts):
                break
            starts = starts[self._at(starts + i, at, code) == phrase[i]]
        return starts

    def _matches(self, i: int, at: np.ndarray, code: np.ndarray) -> list[tuple[str, int, float]]:
        """(label, place, score) of the places of one template, best first where they overlap."""
        label, keys, template = self.templates[i]
        stands = [self._phrase(k, at, code) for k in keys]
        if not all(map(len, stands)):
            return []
        drift = np.arange(-DRIFT, DRIFT + 1)
        offsets = [at[code == w][:, None, None] - places[None, :, None] - drift for w, places in self.rare[i].items()]
        offsets = np.unique(np.concatenate([x.ravel() for x in offsets]))
        size, total = len(template), self.idf[template].sum()
        found = []
        for start in range(0, len(offsets), 1 << 12):
            some = offsets[start:start + (1 << 12)]
            there = np.zeros((len(some), size), dtype=bool)
            for d in drift:
                there |= self._at(some[:, None] + np.arange(size) + d, at, code) == template
            score = (there @ self.idf[template]) / total
            ok = score >= self.least
            for k, s in zip(keys, stands):  # the phrase begins and ends within the template's words
                low = np.searchsorted(s, some - DRIFT)
                ok &= low < np.searchsorted(s, some + size + DRIFT - len(k), side="right")
            found += zip(some[ok].tolist(), np.minimum(score[ok], 1.0).tolist())
        kept: list[tuple[int, float]] = []
        for place, score in found:  # by place: of overlapping ones the best, then the first
            if kept and place < kept[-1][0] + size:
                if score > kept[-1][1]:
                    kept[-1] = place, score
            else:
                kept.append((place, score))
        return [(label, max(place, 0), score) for place, score in kept]


def word_document_counts(docs: DataFrame, vocabulary: list[str], text_col: str = "text") -> tuple[dict[str, int], int]:
    """In how many of all documents each word of a (small) vocabulary stands, and the number of documents."""
    found = F.array_intersect(F.regexp_extract_all(ascii_lower(text_col), F.lit(WORD_SQL), F.lit(0)),
                              F.array(*[F.lit(w) for w in vocabulary]))
    rows = docs.select(F.explode(F.concat(F.coalesce(found, F.array().cast("array<string>")), F.array(F.lit("")))).alias("w"))
    counts = {r["w"]: r["n"] for r in rows.groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()}
    return counts, counts.pop("", 0)  # a row for each word of the vocabulary, and one for the documents


def scan_licenses(docs: DataFrame, phrases: list[tuple[str, str]], templates: list | None = None, *, score: float = SCORE,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per file: ``id``, ``n_words``; for the ``phrases`` (label, words)
    ``n_base`` (all places), ``first_word`` and ``last_word`` (their smallest and
    largest start, else null) and ``base_labels``; ``labels`` (those of matching
    ``templates`` too; sorted), ``score`` (1 with a phrase, else the best match's, else
    0) and ``matches`` (label, word, score).

    Whole texts are read. A null text is an empty one; null and repeated ids and
    repeated rows are files like others; columns beside id and text are not read. An
    empty table gives no rows.
    """
    templates = TEMPLATES if templates is None else templates
    vocabulary = sorted({w for _, p in phrases for w in words(p)} | {w for _, keys, t in templates for x in (t, *keys) for w in words(x)})
    kept = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    index = Index(phrases, templates, *word_document_counts(kept, vocabulary), score=score)
    sent = docs.sparkSession.sparkContext.broadcast(index)
    schema = SCAN.format(id=kept.schema["id"].dataType.simpleString())
    names = re.findall(r"(\w+) (?:\w+|array<string>|array<struct<[^>]*>>)(?:, |$)", schema)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = pd.DataFrame([sent.value.scan(t) for t in batch["text"]], columns=names[1:])
            for c in ("first_word", "last_word"):
                rows[c] = rows[c].astype("Int64")
            rows.insert(0, "id", batch["id"].to_numpy(object) if batch["id"].isna().any() else batch["id"].to_numpy())
            yield rows

    return kept.mapInPandas(scan, schema)
