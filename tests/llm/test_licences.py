import re

from stratamart.llm import licences
from stratamart.llm.queries import op7_license_scans
from tests.llm.helpers import SMALL, clashing, documents, empty, odd_rows, texts

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    starts, labels = [], set()
    for label, phrase in licences.PHRASES.items():
        phrase = phrase.split()
        for i in range(len(words)):
            if words[i : i + len(phrase)] == phrase:
                starts.append(i)
                labels.add(label)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def test_base_is_the_definition(spark):
    extra = [
        "CC BY cc-by cc,by ccby CC\nBY", "All rights reserved. all RIGHTS reserved", "all rights\u00a0reserved",
        "General Public License general public licence", "\u212aall rights reserved", "by cc by",
    ]
    rows = [*texts(spark).items(), *enumerate(extra, 1000)]
    expected = {i: brute(t) for i, t in rows}
    out = licences.scan(documents(spark, rows)).collect()
    for r in out:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == expected[r.doc_id]
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert {r.doc_id for r in op7_license_scans(spark, SMALL).collect()} == set(texts(spark))


def test_notices_are_found_and_key_phrases_are_mandatory(spark):
    rows = [
        (1, "Some code. Released under the MIT License. More."),
        (2, "Licensed under the Apache License, Version 2.0 (the License)"),
        (3, "this program is free software; you can redistribute it and/or modify it under the terms of"
            " the GNU General Public License as published by the Free Software Foundation, version 3"),
        (4, "Released under the terms of a treaty"),
        (5, "Licensed under CC BY-NC 4.0."),
        (6, "Redistribution and use in source and binary forms, with or without any modification, are"
            " permitted provided that the following conditions are met"),
        (7, "license license license license apache"),
    ]
    out = {r.doc_id: r.labels for r in licences.scan(documents(spark, rows)).collect()}
    assert out == {1: "mit", 2: "apache-2.0", 3: "gpl", 4: "", 5: "cc-by,cc-by-nc", 6: "bsd", 7: ""}


def test_awkward_rows(spark):
    out = licences.scan(clashing(documents(spark, odd_rows()))).collect()
    assert len(out) == len(odd_rows())
    assert all(r.labels == "" and r.score == 0 and r.first_word is None for r in out)
    assert licences.scan(empty(spark)).count() == 0
