import hashlib
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from stratamart.llm import fingerprints
from stratamart.llm.queries import op9_fingerprints
from tests.llm.helpers import SMALL, clashing, documents, empty, odd_rows, texts


def sketch(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    hashes = set()
    for i in range(max(1, len(words) - 4) if words else 0):
        seed = 42
        for word in words[i : i + 5]:
            seed = xxhash.xxh64_intdigest(word.encode(), seed)
        hashes.add(seed - (1 << 64) if seed >> 63 else seed)
    low = {h for h in hashes if h < -(1 << 63) + (1 << 62)}
    return low | ({min(hashes)} if hashes else set())


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_query_is_the_definition(spark):
    rows = sorted(texts(spark).items())
    out = {r.doc_id: r for r in op9_fingerprints(spark, SMALL).collect()}
    assert len(out) == len(rows)
    for k, (i, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        r, own = out[i], sketch(text)
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == "".join("%016x" % (h % (1 << 64)) for h in sorted(own))
        assert r.near_edited == likeness(own, sketch(edited))
        assert r.near_next == likeness(own, sketch(after))


@pytest.mark.parametrize("ids", [[5], [-3, 0, 10**12, 7], list(range(0, 4000, 7))])
def test_next_row_by_id(spark, ids):
    docs = documents(spark, [(i, f"text {i}") for i in ids])
    out = fingerprints.with_next(docs, {"text": F.col("text")}).collect()
    order = sorted(ids)
    expected = {i: f"text {order[(k + 1) % len(order)]}" for k, i in enumerate(order)}
    assert {r.doc_id: r.next_text for r in out} == expected and len(out) == len(ids)


def test_awkward_rows(spark):
    docs = clashing(documents(spark, odd_rows()))
    out = fingerprints.with_next(docs, {"text": F.coalesce("text", F.lit(""))}).collect()
    assert len(out) == len(odd_rows())
    rows = fingerprints.fingerprints(docs).collect()
    assert {len(r.sketch) for r in rows if r.doc_id in (1, 2, 3)} == {0}
    assert fingerprints.with_next(empty(spark), {"text": F.col("text")}).count() == 0


def test_containment_of_unequal_documents(spark):
    words = [f"w{i}" for i in range(4000)]
    rows = [(1, " ".join(words[:400])), (2, " ".join(words))]
    both = [r.sketch for r in fingerprints.fingerprints(documents(spark, rows)).orderBy("doc_id").collect()]
    one = spark.createDataFrame([both], "a array<long>, b array<long>")
    r = one.select(
        fingerprints.containment(F.col("a"), F.col("b")).alias("c"),
        fingerprints.likeness(F.col("a"), F.col("b")).alias("l"),
        (fingerprints.merge(F.col("a"), F.col("b")) == F.col("b")).alias("merged"),
    ).first()
    assert r.c == 1.0 and abs(r.l - 0.1) < 0.05 and r.merged
