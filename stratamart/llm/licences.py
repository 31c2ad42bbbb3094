"""Licence detection with a positional index over the rarest words of licence templates.

The templates are few and fixed; their index (word -> template, position) is small and goes
with the tasks. How rare a word is comes from the corpus: a first pass counts, for the words
of the templates only, in how many of all documents they occur. The second pass looks up
each document's occurrences of the templates' rarest words, intersects the postings by
relative position (occurrences that put the same template at the same place), and verifies
the mandatory key phrases there. A document without any rare licence word is done at once.

``phrase`` templates must stand word for word and every place counts; ``text`` templates may
differ in some words and may be shifted by a few.

Defined cases: a null or empty text has no words, no labels and score 0; repeated rows give
equal rows; an empty table gives no rows; long texts are read whole. Only id and text are
read, so other columns cannot clash.
"""

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, functions as F

#: A word: letters, digits and everything beyond ASCII, in UTF-8.
TOKEN = rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Rarest words of a text template that are looked up, and words an alignment may slip.
ANCHORS = 4
SLACK = 4
#: Share of a text template's words that must stand near their places.
LEAST_SHARE = 0.75

# Phrases that count word for word, by label.
PHRASES = {
    "cc-by": "cc by",
    "gpl": "general public license",
    "reserved": "all rights reserved",
}
# Usual wordings of licence notices, with the phrases each must hold.
NOTICES = [
    ("mit", "Released under the MIT License", ["mit license"]),
    ("mit", "Licensed under the MIT License", ["mit license"]),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
        " software and associated documentation files",
        ["permission is hereby granted", "free of charge"],
    ),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0", ["apache license", "2 0"]),
    (
        "gpl-3",
        "This work is licensed under the GNU General Public License, version 3",
        ["gnu general public license", "version 3"],
    ),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the"
        " terms of the GNU General Public License as published by the Free Software Foundation",
        ["gnu general public license"],
    ),
    (
        "lgpl",
        "under the terms of the GNU Lesser General Public License as published by the Free"
        " Software Foundation",
        ["lesser general public license"],
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are"
        " permitted provided that the following conditions are met",
        ["redistribution and use in source and binary forms"],
    ),
    (
        "mpl-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        ["mozilla public license"],
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with"
        " or without fee is hereby granted",
        ["permission to use copy modify", "with or without fee"],
    ),
    (
        "unlicense",
        "This is free and unencumbered software released into the public domain",
        ["free and unencumbered software"],
    ),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0", ["cc by nc"]),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0", ["cc by sa"]),
    ("cc-by", "Licensed under CC BY 4.0", ["cc by"]),
    (
        "cc-by",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
        ["creative commons attribution"],
    ),
    ("cc0", "CC0 1.0 Universal Public Domain Dedication", ["cc0"]),
]


def words_of(text: str | None) -> list[bytes]:
    """Words of a text in UTF-8, with A-Z in lower case and nothing else changed."""
    return re.findall(TOKEN, (text or "").encode("utf-8", "surrogatepass").lower())


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[bytes, ...]
    keys: tuple[tuple[bytes, ...], ...]
    exact: bool


def templates() -> list[Template]:
    def phrase(text):
        return tuple(words_of(text))

    exact = [Template(label, phrase(p), (phrase(p),), True) for label, p in PHRASES.items()]
    notices = [
        Template(label, phrase(text), tuple(map(phrase, keys)), False)
        for label, text, keys in NOTICES
    ]
    return exact + notices


def document_frequencies(docs: DataFrame) -> tuple[int, dict[bytes, int]]:
    """The number of documents, and in how many each template word occurs.

    Every task counts its documents and sends one row per word, so what reaches the driver
    is bounded by the templates' vocabulary.
    """
    vocabulary = {word for template in templates() for word in template.words}

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch["text"]:
                seen[b""] += 1
                seen.update(vocabulary.intersection(words_of(text)))
        yield pd.DataFrame({"word": list(seen), "n": list(seen.values())})

    rows = (
        docs.select("text")
        .mapInPandas(count, "word binary, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    counts = {bytes(row.word): row.n for row in rows}
    return counts.pop(b"", 0), counts


class Index:
    """Postings of the rarest words of each template."""

    def __init__(self, known: list[Template], n_docs: int, counts: dict[bytes, int]):
        self.templates = known
        self.postings: dict[bytes, list[tuple[int, int]]] = {}
        self.needed = []
        for number, template in enumerate(known):
            idf = {w: math.log((n_docs + 1) / (counts.get(w, 0) + 1)) for w in template.words}
            rarest = sorted(idf, key=lambda w: (-idf[w], w))[: 1 if template.exact else ANCHORS]
            self.needed.append((len(rarest) + 1) // 2)
            for position, word in enumerate(template.words):
                if word in rarest:
                    self.postings.setdefault(word, []).append((number, position))

    def places(self, words: list[bytes]) -> dict[int, dict[int, set[bytes]]]:
        """Template -> where in the document it would start -> the rare words that say so."""
        rare = self.postings.keys() & set(words)
        votes: dict[int, dict[int, set[bytes]]] = {}
        if rare:
            for at, word in enumerate(words):
                if word in rare:
                    for number, position in self.postings[word]:
                        starts = votes.setdefault(number, {})
                        starts.setdefault(at - position, set()).add(word)
        return votes

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str], float]:
        """Places of exact phrases (template, start), labels of notices, and the score.

        The score is the share of its template's words found by the best place: 1 for an
        exact phrase.
        """
        exact, labels, score = [], set(), 0.0
        for number, starts in self.places(words).items():
            template = self.templates[number]
            if template.exact:
                size = len(template.words)
                found = [
                    (number, s) for s in starts if s >= 0 and tuple(words[s : s + size]) == template.words
                ]
                exact += found
                score = 1.0 if found else score
                continue
            for start in starts:
                near = set().union(*(starts.get(start + d, ()) for d in range(-SLACK, SLACK + 1)))
                if len(near) < self.needed[number]:
                    continue
                share, whole = self.verify(template, words, start)
                score = max(score, share)
                if whole and share >= LEAST_SHARE:
                    labels.add(template.label)
        return exact, labels, score

    @staticmethod
    def verify(template: Template, words: list[bytes], start: int) -> tuple[float, bool]:
        """Share of the template's words near their places; whether all key phrases stand."""
        low = max(0, start - SLACK)
        window = words[low : max(0, start + len(template.words) + SLACK)]
        hits = sum(
            word in words[max(0, start + i - SLACK) : max(0, start + i + SLACK + 1)]
            for i, word in enumerate(template.words)
        )
        keys = all(
            any(tuple(window[i : i + len(key)]) == key for i in range(len(window)))
            for key in template.keys
        )
        return hits / len(template.words), keys


def scan(docs: DataFrame) -> DataFrame:
    """Per row: number of words, places of exact phrases, labels and score."""
    n_docs, counts = document_frequencies(docs)
    index = Index(templates(), n_docs, counts)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                words = words_of(text)
                exact, labels, score = index.scan(words)
                base = {index.templates[number].label for number, _ in exact}
                starts = [start for _, start in exact]
                rows.append(
                    (
                        len(words),
                        len(starts),
                        min(starts, default=None),
                        max(starts, default=None),
                        ",".join(sorted(base)),
                        ",".join(sorted(base | labels)),
                        score,
                    )
                )
            made = pd.DataFrame(rows, columns=COLUMNS)
            made = made.astype({"first_word": "Int64", "last_word": "Int64"})
            made.insert(0, "doc_id", batch["doc_id"])
            yield made

    return docs.select("doc_id", "text").mapInPandas(task, f"doc_id {kind}, {SCHEMA}")


COLUMNS = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
SCHEMA = (
    "n_words long, n_base long, first_word long, last_word long,"
    " base_labels string, labels string, score double"
)
