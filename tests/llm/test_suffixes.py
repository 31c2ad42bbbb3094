import hashlib

import pytest
from hypothesis import given, settings, strategies as st

from stratamart.llm import suffixes
from stratamart.llm.queries import op1_suffix_dedup
from tests.llm.helpers import SMALL, clashing, documents, empty, odd_rows, texts


def brute(texts_by_id: list[tuple], threshold=50):
    """Remaining bytes and number of spans of every document, by the definition."""
    seen: dict[bytes, int] = {}
    for i, text in texts_by_id:
        b = text.encode()
        for p in range(len(b) - threshold + 1):
            s = b[p : p + threshold]
            seen[s] = min(seen.get(s, i), i)
    out = []
    for i, text in texts_by_id:
        b = text.encode()
        gone = bytearray(len(b))
        for p in range(len(b) - threshold + 1):
            if seen[b[p : p + threshold]] < i:
                gone[p : p + threshold] = b"\1" * threshold
        spans = sum(1 for p in range(len(b)) if gone[p] and (p == 0 or not gone[p - 1]))
        out.append((i, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return out


def found(df):
    rows = df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept").collect()
    return sorted((r[0], r[1], r[2], r[3], bytes(r[4])) for r in rows)


def test_query_is_the_definition(spark):
    expected = [
        (i, n, r, s, hashlib.sha256(k).hexdigest())
        for i, n, r, s, k in brute(sorted(texts(spark).items()))
    ]
    assert sorted(map(tuple, op1_suffix_dedup(spark, SMALL).collect())) == expected


@pytest.mark.parametrize("part_bytes", [300, 2_500_000])
def test_periodic_and_overlapping_texts(spark, monkeypatch, part_bytes):
    monkeypatch.setattr(suffixes, "PART_BYTES", part_bytes)
    block = "".join(chr(97 + (i * i + 3 * i) % 26) for i in range(120))
    rows = [
        (1, "a" * 200),
        (2, "a" * 70 + "b" + "a" * 49),
        (3, "ab" * 60),
        (4, "x" + "ba" * 30),
        (5, block),
        (6, block[10:65] + "|" + block[:49] + "|" + block[70:]),
        (7, block[30:79]),
        (8, "zz" + block[30:80]),
        (9, block + block),
        (10, "é" * 40),
        (11, "ü" + "é" * 30),
    ]
    df = suffixes.remove_repeats(documents(spark, rows))
    assert found(df) == brute(rows)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text("ab", max_size=160), min_size=1, max_size=12))
def test_random_texts(spark, made):
    rows = list(enumerate(made))
    assert found(suffixes.remove_repeats(documents(spark, rows))) == brute(rows)


def test_awkward_rows(spark):
    rows = odd_rows()
    out = suffixes.remove_repeats(clashing(documents(spark, rows))).collect()
    assert len(out) == len(rows)
    removed = {(r.doc_id, r.n_bytes): r.n_removed for r in out}
    size = len(odd_rows()[3][1])
    assert removed[(5, size)] == size and removed[(4, size)] == 0
    assert all(r.n_removed == 0 for r in out if r.doc_id is None)
    kept = suffixes.deduplicate(clashing(documents(spark, rows)))
    assert kept.columns == clashing(documents(spark, rows)).columns
    assert sorted((r.doc_id or 0, r.text is None) for r in kept.collect()) == sorted(
        (i or 0, t is None) for i, t in rows
    )
    assert suffixes.remove_repeats(empty(spark)).count() == 0
    assert suffixes.deduplicate(empty(spark)).count() == 0


def test_rows_without_an_id_are_not_brought_together(spark):
    """A third of the rows: they keep their texts and are in no part; no table stays listed."""
    long = "the same long text that stands in very many documents of this table, id or not"
    rows = [(i if i % 3 else None, long) for i in range(300)]
    tables = {t.name for t in spark.catalog.listTables()}
    out = suffixes.remove_repeats(documents(spark, rows)).collect()
    assert {t.name for t in spark.catalog.listTables()} == tables
    size = len(long)
    assert sorted((r.doc_id is None, r.n_removed) for r in out) == [(False, 0)] + [(False, size)] * 199 + [(True, 0)] * 100
    kept = suffixes.deduplicate(documents(spark, rows)).collect()
    assert sum(r.text == long for r in kept) == 101 and len(kept) == 300


def test_texts_come_from_the_parts(spark):
    """No Python function of the joined rows: with a filter on the text it took two more workers a task."""
    head = "w" * 49
    rows = [(1, head + "é"), (2, head + "ã tail"), (None, head + "é"), (None, None), (3, None), (3, "")]
    cut = suffixes.deduplicate(documents(spark, rows))
    plan = cut.filter(cut["text"].rlike(r"\S"))._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInPandas" in plan and "EvalPython" not in plan
    # Documents 1 and 2 share the first byte of é and ã.
    expected = [(None, head + "é"), (None, None), (1, head + "é"), (2, " tail"), (3, None), (3, "")]
    assert sorted(((r.doc_id, r.text) for r in cut.collect()), key=repr) == sorted(expected, key=repr)


def test_answers_need_no_rows_from_python(spark):
    """Only the documents are made here from Python's rows, and they are stored before the rounds."""
    docs = documents(spark, [(1, "text"), (None, "text")]).filter("doc_id IS NOT NULL")
    rounds = suffixes.remove_repeats(docs)._jdf.queryExecution().executedPlan().toString()
    docs_scans = docs._jdf.queryExecution().executedPlan().toString().count("ExistingRDD")
    # The rows without an id read the documents once more.
    assert rounds.count("ExistingRDD") == docs_scans
