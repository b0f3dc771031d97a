"""Licence scan with a positional rare-token index (operator 1).

The templates are sequences of words: the base phrases, one-sentence notices
and the clauses that whole licence texts are made of.  The index has the
places of all their words.  For a file, the template words that it has with
the highest inverse document frequency (over all documents) are looked up;
their places in file and template give starts at which the template may
stand, and only starts on which several of them agree are verified: a
mandatory key phrase has to stand there word for word, and of a clause half of
its weight around it.  A text that has lost one clause is told by the others.
"""
from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlens.llm import common as U

# Phrases and labels of the base, then notice texts by label.
BASE = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
#: label, mandatory key phrase, notice
NOTICES = (
    ("apache", "apache license", "licensed under the apache license version 2 0"),
    ("apache", "apache license", "licensed under the apache license version 2 0 the license you may not use this file "
     "except in compliance with the license"),
    ("bsd", "redistribution and use in source and binary forms", "redistribution and use in source and binary forms "
     "with or without modification are permitted provided that the following conditions are met"),
    ("cc-by", "under cc by 4 0", "licensed under cc by 4 0"),
    ("cc-by", "creative commons attribution 4 0", "licensed under the creative commons attribution 4 0 international license"),
    ("cc-by-nc", "cc by nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "cc by sa", "licensed under cc by sa 4 0"),
    ("gpl", "general public license", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "general public license", "you can redistribute it and or modify it under the terms of the gnu general "
     "public license as published by the free software foundation"),
    ("isc", "permission to use copy modify and or distribute", "permission to use copy modify and or distribute this "
     "software for any purpose with or without fee is hereby granted"),
    ("lgpl", "lesser general public license", "licensed under the gnu lesser general public license version 3"),
    ("mit", "mit license", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge", "permission is hereby granted free of charge to any person "
     "obtaining a copy of this software and associated documentation files"),
    ("mpl", "mozilla public license", "this source code form is subject to the terms of the mozilla public license v 2 0"),
)
#: label, mandatory key phrase, clause
CLAUSES = (
    ("apache", "software distributed under the license is distributed on an as is basis", "unless required by applicable law or "
     "agreed to in writing software distributed under the license is distributed on an as is basis without warranties or "
     "conditions of any kind either express or implied"),
    ("bsd", "redistributions of source code must retain the above copyright notice", "redistributions of source code must "
     "retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice", "redistributions in binary form must "
     "reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or "
     "other materials provided with the distribution"),
    ("bsd", "this software is provided by the copyright holders and contributors as is", "this software is provided by the "
     "copyright holders and contributors as is and any express or implied warranties including but not limited to the implied "
     "warranties of merchantability and fitness for a particular purpose are disclaimed"),
    ("bsd-3", "may be used to endorse or promote products derived from this software", "may be used to endorse or promote "
     "products derived from this software without specific prior written permission"),
    ("epl", "eclipse public license", "the accompanying materials are made available under the terms of the eclipse public license"),
    ("gpl", "see the gnu general public license for more details", "without even the implied warranty of merchantability or "
     "fitness for a particular purpose see the gnu general public license for more details"),
    ("isc", "the author disclaims all warranties with regard to this software", "the software is provided as is and the author "
     "disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness"),
    ("lgpl", "see the gnu lesser general public license for more details", "without even the implied warranty of merchantability "
     "or fitness for a particular purpose see the gnu lesser general public license for more details"),
    ("mit", "deal in the software without restriction", "to deal in the software without restriction including without "
     "limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("mit", "this permission notice shall be included in all copies", "the above copyright notice and this permission notice "
     "shall be included in all copies or substantial portions of the software"),
    ("mit", "in no event shall the authors or copyright holders be liable", "in no event shall the authors or copyright holders "
     "be liable for any claim damages or other liability whether in an action of contract tort or otherwise"),
    ("unlicense", "free and unencumbered software released into the public domain", "this is free and unencumbered software "
     "released into the public domain"),
    ("unlicense", "anyone is free to copy modify publish use compile sell or distribute", "anyone is free to copy modify publish "
     "use compile sell or distribute this software either in source code form or as a compiled binary for any purpose"),
    ("zlib", "in no event will the authors be held liable for any damages", "this software is provided as is without any express "
     "or implied warranty in no event will the authors be held liable for any damages arising from the use of this software"),
    ("zlib", "altered source versions must be plainly marked as such", "altered source versions must be plainly marked as such "
     "and must not be misrepresented as being the original software"),
)
#: Words of a template looked up for a file, and how many have to agree on a start.
ANCHORS, AGREE = 4, 2
#: Share of a clause's weight that has to stand around its key phrase.
CLAUSE_SHARE = 0.5

_KEEP = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
WORD_BYTES = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c in _KEEP else 0x20 for c in range(256))


def words_of(text: str) -> list[bytes]:
    """Runs of digits, letters and non-ASCII characters, A-Z lower-cased."""
    return text.encode().translate(WORD_BYTES).split()


class Index:
    """Places of the templates' words, looked up by a file's rarest ones."""

    def __init__(self, idf: dict[bytes, float], anchors: int = ANCHORS):
        self.idf, self.anchors = idf, anchors
        sides = [(label, phrase, phrase, "base") for phrase, label in BASE.items()]
        sides += [(label, phrase, notice, "notice") for label, phrase, notice in NOTICES]
        sides += [(label, phrase, clause, "clause") for label, phrase, clause in CLAUSES]
        self.templates = [(label, words.encode().split(), phrase.encode().split(), kind) for label, phrase, words, kind in sides]
        self.places: list[dict[bytes, list[int]]] = []
        self.rarest, self.phrase_words, self.offset, self.weight = [], [], [], []
        for _, words, phrase, kind in self.templates:
            places: dict[bytes, list[int]] = defaultdict(list)
            for k, w in enumerate(words):
                places[w].append(k)
            self.places.append(places)
            # A notice is known by its phrase alone; a clause by any of its words.
            own = set(words if kind == "clause" else phrase)
            self.rarest.append(sorted(own, key=lambda w: (-idf.get(w, 0.0), w)))
            self.phrase_words.append(frozenset(phrase))
            self.offset.append(next(k for k in range(len(words)) if words[k:k + len(phrase)] == phrase))
            self.weight.append([idf.get(w, 0.0) for w in words])
        self.words = frozenset(w for p in self.places for w in p)

    def scan(self, text: str) -> tuple:
        """(words, base places by label, [(template label, start, coverage)])."""
        words = words_of(text)
        have = self.words.intersection(words)
        live = [t for t, need in enumerate(self.phrase_words) if need <= have] if have else []
        if not live:
            return len(words), {}, []
        wanted: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        need = {}
        for t in live:
            anchors = [w for w in self.rarest[t] if w in have][:self.anchors]
            need[t] = min(AGREE, len(anchors))
            for w in anchors:
                wanted[w] += [(t, place) for place in self.places[t][w]]
        votes: dict[tuple[int, int], set] = defaultdict(set)
        for at, w in enumerate(words):
            if w in wanted:
                for t, place in wanted[w]:
                    votes[t, at - place].add(w)
        base: dict[str, list[int]] = defaultdict(list)
        spans = []
        for (t, start), rare in votes.items():
            if len(rare) < need[t]:
                continue
            label, template, phrase, kind = self.templates[t]
            first = start + self.offset[t]
            if first < 0 or words[first:first + len(phrase)] != phrase:
                continue
            if kind == "base":
                base[label].append(start)
                spans.append((label, start, 0.0))
                continue
            weight = self.weight[t]
            hit = sum(x for k, (w, x) in enumerate(zip(template, weight))
                      if 0 <= start + k < len(words) and words[start + k] == w)
            share = hit / sum(weight) if sum(weight) else 1.0
            if kind == "notice" or share >= CLAUSE_SHARE:
                spans.append((label, first, share))
        return len(words), base, spans


def vocabulary() -> set[bytes]:
    return {w for p in (*BASE, *(n for _, _, n in NOTICES + CLAUSES)) for w in p.encode().split()}


def document_frequencies(docs: DataFrame) -> dict[bytes, float]:
    """IDF of the templates' words over all documents.  Tasks send one row per
    word of the templates and batch; the result has one per word."""
    words = vocabulary()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = Counter()
            for text in batch.column("text"):
                seen.update(words.intersection(words_of(text.as_py())))
            keys = [b"", *seen]
            yield pa.RecordBatch.from_arrays([pa.array([k.decode() for k in keys]),
                                              pa.array([batch.num_rows, *seen.values()], pa.int64())], names=["word", "n"])

    rows = U.doc_text(docs).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    df = {r["word"].encode(): r["n"] for r in rows}
    total = df.pop(b"", 0)
    return {w: math.log((1 + total) / (1 + df.get(w, 0))) + 1 for w in words}


SCANNED = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
           "labels string, score double, spans array<struct<label:string,start:long,coverage:double>>")


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` with the verified spans.

    Null and empty texts have no words, no labels and score 0.  The score is 0
    without a label, else 0.5 plus half the best share of a notice's weight
    that stands around its key phrase."""
    idf = document_frequencies(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(idf)
        span = pa.struct([("label", pa.string()), ("start", pa.int64()), ("coverage", pa.float64())])
        types = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64(), pa.list_(span)]
        names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                n, base, spans = index.scan(text.as_py())
                starts = [s for places in base.values() for s in places]
                rows.append((doc_id, n, len(starts), min(starts, default=None), max(starts, default=None),
                             ",".join(sorted(base)), ",".join(sorted({s[0] for s in spans})),
                             0.5 + 0.5 * max(s[2] for s in spans) if spans else 0.0,
                             [dict(zip(("label", "start", "coverage"), s)) for s in sorted(spans)]))
            cols = zip(*rows) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    return U.doc_text(docs).mapInArrow(run, SCANNED)


def op1_license_scan(spark, sf_dir: str) -> DataFrame:
    return scan(U.documents(spark, sf_dir)).drop("spans")
