"""The manifest against a plain recursive tree."""

import zlib
from collections import defaultdict
from hashlib import sha256

import pytest

from stratamart.llm import merkle
from stratamart.llm.queries import op11_merkle_manifest
from tests.llm.helpers import DOCUMENTS, SMALL, clashing, empty


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def levels_of(nodes):
    every = [nodes]
    while len(every[-1]) > 1:
        last = every[-1]
        every.append([h(*last[i : i + 2]) for i in range(0, len(last), 2)])
    return every


def siblings(every, at):
    found = []
    for level in every[:-1]:
        found.append((at % 2, level[at ^ 1] if (at ^ 1) < len(level) else None))
        at //= 2
    return found


def expected(rows):
    """Manifest of (doc_id, text, lang, source, n_chars) rows, by definition."""
    trees = defaultdict(list)
    for doc, text, lang, source, n in rows:
        own = h(*map(field, (doc, source, lang, n, text)))
        tampered = doc is not None and n is not None and zlib.crc32(str(doc).encode()) % 7 == 0
        claimed = h(*map(field, (doc, source, lang, n + 1, text))) if tampered else own
        trees[lang].append((doc is not None, doc, own, claimed))
    order = sorted(trees, key=lambda t: (t is not None, (t or "").encode()))
    built = {t: levels_of([r[2] for r in sorted(trees[t], key=lambda r: (r[0], r[1] or 0, r[2], r[3]))]) for t in order}
    top = levels_of([built[t][-1][0] for t in order])
    out = []
    for number, t in enumerate(order):
        for at, (_, doc, own, claimed) in enumerate(sorted(trees[t], key=lambda r: (r[0], r[1] or 0, r[2], r[3]))):
            way = siblings(built[t], at) + siblings(top, number)
            node = claimed
            for right, other in way:
                node = h(node) if other is None else h(other, node) if right else h(node, other)
            proof = h(*[other for _, other in way if other])
            out.append((doc, own, built[t][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return out


def key(row):
    return [(v is not None, v) for v in row]


def assert_same(rows, docs):
    assert sorted(map(tuple, rows), key=key) == sorted(expected(docs), key=key)


def query(spark, docs, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    return op11_merkle_manifest(spark, str(tmp_path)).collect()


def plain(docs):
    return [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]


@pytest.mark.parametrize("bits", [2, 3, 12])
def test_query_against_definition(spark, monkeypatch, bits):
    """Small superblocks make several steps up and down."""
    monkeypatch.setattr(merkle.prove, "__defaults__", (bits,))
    monkeypatch.setattr(merkle.manifest, "__defaults__", (None, bits))
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert_same(op11_merkle_manifest(spark, SMALL).collect(), plain(docs))


def test_awkward_rows(spark, tmp_path):
    rows = [
        (1, None, None, None, None),
        (2, "", "", "", 0),
        (3, "é日🙂\x00", "zz", "s", 4),
        (3, "other", "zz", "s", None),
        (4, "same", "de", "s", 4),
        (4, "same", "de", "s", 4),
        (None, "no id", None, "s", 5),
        (None, None, "de", None, None),
        (5, "x" * 300_000, "é", "s", 300_000),
        *[(i, f"t{i}", "en", "s", i) for i in range(6, 40)],
        *[(i, "lone", f"l{i}", "s", 4) for i in range(40, 57)],
    ]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    assert_same(query(spark, clashing(docs), tmp_path), rows)


@pytest.mark.parametrize("rows", [[], [(7, "a", "x", "s", 1)], [(7, "a", "x", "s", 1), (9, "b", None, "s", 1)]])
def test_few_rows(spark, tmp_path, rows):
    docs = spark.createDataFrame(rows, DOCUMENTS) if rows else empty(spark)
    assert_same(query(spark, docs, tmp_path), rows)


def test_tampering_shows(spark):
    rows = op11_merkle_manifest(spark, SMALL).collect()
    assert {r.verified for r in rows} == {True, False}
    assert all(r.verified == (zlib.crc32(str(r.doc_id).encode()) % 7 != 0) for r in rows)
