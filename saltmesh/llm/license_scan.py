"""License scan by a positional rare-token index.

Every template is a short word sequence with a mandatory key phrase. The index maps each template word to its postings
(template, position). A document looks up its licence words from the highest IDF down. Each posting of a word's place
names the place where the template would have to start (word position less template position), and the postings of the words
are intersected there: a place begins with one of the template's rarest words, its head, and gathers the IDF of every later
word that agrees. The head is as long as the rest of the template is too light to be enough without it, so that no place is
missed, and what else a file holds makes no difference. Places that can still reach enough are verified: the key phrase must
stand there word by word, and the share of the template's IDF weight is then counted from all its words. A label is given if one
of its templates is found. IDF is counted over all documents.

The base phrases are templates of their own that are all key phrase.

Defined results: null or empty text gives n_words 0, no labels, null first_word/last_word and score 0. Rows that repeat
are scanned each on their own. An empty table gives an empty result. Extra columns are ignored. A document of any
length is scanned whole.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import table

# The base phrases of the contract.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Templates, as (label, words, key phrase): notices that files carry, sentences of the licences themselves, and SPDX tags. A
# template's words may be missing in a file, its key phrase not. A licence has as many templates as it has notices.
SPDX = {
    "apache-2.0": "apache 2 0", "bsd": "bsd", "cc-by-nc-4.0": "cc by nc 4 0", "cc-by-sa-4.0": "cc by sa 4 0", "cc0": "cc0 1 0", "gpl-2.0": "gpl 2 0", "gpl-3.0": "gpl 3 0",
    "lgpl": "lgpl", "agpl": "agpl", "mit": "mit", "mpl-2.0": "mpl 2 0", "isc": "isc", "zlib": "zlib", "bsl-1.0": "bsl 1 0", "unlicense": "unlicense",
}
TEMPLATES = [
    *((label, f"spdx license identifier {tag}", f"spdx license identifier {tag}") for label, tag in SPDX.items()),
    ("agpl", "under the terms of the gnu affero general public license as published by the free software foundation", "gnu affero general public license"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0", "apache org licenses license 2 0"),
    ("apache-2.0", "apache license version 2 0 january 2004 http www apache org licenses terms and conditions for use reproduction and distribution", "apache license version 2 0 january 2004"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer", "redistributions of source code must retain the above copyright"),
    ("bsl-1.0", "distributed under the boost software license version 1 0", "boost software license version 1"),
    ("gpl-2.0", "under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version", "free software foundation either version 2 of the license"),
    ("gpl-3.0", "under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version", "free software foundation either version 3 of the license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "for any purpose with or without fee is hereby granted"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", "to any person obtaining a copy of this software and associated documentation files"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file", "subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software released into the public domain"),
    ("zlib", "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely", "granted to anyone to use this software for any purpose including commercial applications"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc0", "dedicated to the public domain under cc0 1 0 universal", "cc0 1 0"),
    ("gpl-2.0", "licensed under the gnu general public license version 2", "general public license version 2"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", "general public license version 3"),
    ("lgpl", "licensed under the gnu lesser general public license", "lesser general public license"),
    ("mit", "released under the mit license", "the mit license"),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
]

#: Share of a template's IDF weight that must agree at a place.
ENOUGH = 0.6

#: A-Z to a-z; every other byte below 128 that is no digit or letter to a space; bytes of longer characters stay.
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))

SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(WORD_BYTES).split()


def _all_templates() -> list[tuple[str, list[bytes], list[bytes], bool]]:
    base = [(label, phrase.encode().split(), phrase.encode().split(), True) for phrase, label in BASE.items()]
    return base + [(label, t.encode().split(), k.encode().split(), False) for label, t, k in TEMPLATES]


def vocabulary() -> frozenset[bytes]:
    return frozenset(w for _, t, _, _ in _all_templates() for w in t)


def document_frequency(docs: DataFrame, text_col: str = "text") -> dict[bytes, int]:
    """Documents that hold each licence word, over all of docs; the result is as large as the licence vocabulary."""
    vocab = vocabulary()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df: Counter = Counter()
        n = 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                n += 1
                df.update(vocab.intersection(words_of(text)))
        words = [b"", *df]
        yield pa.RecordBatch.from_pydict({"word": [w.decode() for w in words], "n": [n, *df.values()]})

    rows = docs.select(F.col(text_col).alias("text")).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    return {r["word"].encode(): r["n"] for r in rows}


class RareTokenIndex:
    """Postings of all template words, with IDF weights of the corpus and the head of each template."""

    def __init__(self, df: dict[bytes, int]):
        n = max(df.get(b"", 0), 1)
        self.templates = _all_templates()
        self.vocab = vocabulary()
        self.idf = {w: math.log((n + 1) / (df.get(w, 0) + 1)) + 1e-3 for w in self.vocab}
        self.weight = [sum(self.idf[w] for w in words) for _, words, _, _ in self.templates]
        #: Weight that a place must have: all of a base phrase.
        self.need = [x * (1.0 if base else ENOUGH) - 1e-9 for x, (_, _, _, base) in zip(self.weight, self.templates, strict=True)]
        self.key_at = [next(i for i in range(len(words)) if words[i : i + len(key)] == key) for _, words, key, _ in self.templates]
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        #: Words of each template, from the rarest on (ties by spelling), without which the others weigh too little.
        self.head: list[frozenset[bytes]] = []
        for t, (_, words, _, _) in enumerate(self.templates):
            for pos, w in enumerate(words):
                self.postings[w].append((t, pos))
            rest, head = self.weight[t], []
            for w, count in sorted(Counter(words).items(), key=lambda x: (-self.idf[x[0]], x[0])):
                if rest < self.need[t]:
                    break
                head.append(w)
                rest -= self.idf[w] * count
            self.head.append(frozenset(head))
        self.rare = frozenset().union(*self.head)

    def share(self, t: int, words: list[bytes], start: int) -> float:
        """Share of a template's IDF weight that agrees with the words from start on; start may lie before the text."""
        template = self.templates[t][1]
        return sum(self.idf[w] for i, w in enumerate(template, start) if 0 <= i < len(words) and words[i] == w) / self.weight[t]

    def intersected(self, words: list[bytes]) -> list[tuple[int, int]]:
        """(template, start) of the places that may weigh enough, from the licence words by falling IDF."""
        at: dict[bytes, list[int]] = defaultdict(list)
        for i, w in enumerate(words):
            if w in self.vocab:
                at[w].append(i)
        found: dict[tuple[int, int], float] = {}
        if self.rare.isdisjoint(at):
            return []
        for w in sorted(at, key=lambda w: (-self.idf[w], w)):
            own: dict[int, list[int]] = {}
            for t, pos in self.postings[w]:
                if w not in self.head[t]:
                    own.setdefault(t, []).append(pos)
                    continue
                for i in at[w]:
                    found[t, i - pos] = found.get((t, i - pos), 0.0) + self.idf[w]
            # Words that open no place are met from the open ones, which are fewer than the places of a common word.
            for t, start in found if own else ():
                for pos in own.get(t, ()):
                    if 0 <= start + pos < len(words) and words[start + pos] == w:
                        found[t, start] += self.idf[w]
        return sorted(place for place, weight in found.items() if weight >= self.need[place[0]])

    def scan(self, text: str | None) -> tuple:
        words = words_of(text)
        places: list[int] = []
        base_labels, labels, score = set(), set(), 0.0
        for t, start in self.intersected(words):
            label, _, key, base = self.templates[t]
            at = start + self.key_at[t]
            if at < 0 or words[at : at + len(key)] != key:
                continue
            if base:
                places.append(start)
                base_labels.add(label)
                score = 1.0
            elif (share := self.share(t, words, start)) >= ENOUGH:
                labels.add(label)
                score = max(score, min(1.0, share))
        return (
            len(words), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(base_labels)), ",".join(sorted(labels | base_labels)), score,
        )


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs, see SCHEMA; labels are distinct, sorted and comma-joined."""
    df = document_frequency(docs, text_col)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = RareTokenIndex(df)
        names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
        for batch in batches:
            found = list(zip(*map(index.scan, batch.column(1).to_pylist()), strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(v, k) for v, k in zip(found, kinds, strict=True))], ["doc_id", *names])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(scan, SCHEMA)


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))
