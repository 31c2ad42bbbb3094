import duckdb

import corpus_pipeline
from stratamart.llm.common import table
from stratamart.llm.oracle import ORACLE
from tests.llm.helpers import clashing, documents, empty, odd_rows
from tests.llm.test_jaccard import brute as linked
from tests.llm.test_lines import brute as without_runs
from tests.llm.test_packing import check as check_packed
from tests.llm.test_suffixes import brute as repeats
from tests.conftest import TESTDATA

SF_DIR = f"{TESTDATA}/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


def run(spark, name, docs):
    out = STAGES[name](spark, docs, SF_DIR)
    if name != "packing":
        assert out.columns == docs.columns
    return out


def test_stages_against_brute_force(spark):
    docs = table(spark, SF_DIR, "documents")
    kept = run(spark, "quality_rules", docs).cache()
    assert 0 < kept.count() < docs.count()
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    judged = duck.sql(f"SELECT doc_id FROM ({ORACLE['op8_quality_rules']}) WHERE kept").fetchall()
    assert {r.doc_id for r in kept.collect()} == {i for (i,) in judged}
    split = run(spark, "line_dedup", kept).cache()
    rows = sorted((r.doc_id, r.text) for r in split.collect())
    lines = without_runs([(r.doc_id, r.text) for r in kept.collect()], 3, 50)
    assert rows == sorted((i, t) for i, (t, _) in lines.items() if t.split())
    one = run(spark, "ngram_jaccard", split).cache()
    expected = {i for i, _, c in linked(rows, 5, 80) if i == c}
    assert {r.doc_id for r in one.collect()} == expected
    rows = sorted((r.doc_id, r.text) for r in one.collect())
    cut = run(spark, "suffix_dedup", one).cache()
    wanted = {i: kept.decode("utf-8", "ignore") for i, _, _, _, kept in repeats(rows)}
    wanted = {i: t for i, t in wanted.items() if t.split()}
    assert {r.doc_id: r.text for r in cut.collect()} == wanted
    assert all(r.n_chars == len(r.text) for r in cut.collect())
    packed = run(spark, "packing", cut).collect()
    check_packed(packed, wanted)
    assert min(r.doc_tokens for r in packed) > 1
    assert sum(r.length for r in packed) == sum({r.doc_id: r.doc_tokens for r in packed}.values())
    whole = corpus_pipeline.run(spark, SF_DIR).collect()
    assert sum(r.length for r in whole) == sum(r.length for r in packed)


def test_awkward_documents_pass_every_stage(spark):
    for docs in (clashing(documents(spark, odd_rows())), empty(spark)):
        for name in STAGES:
            run(spark, name, docs).collect()


def test_documents_left_without_a_word_go(spark):
    """Copies lose all their lines, or all their bytes, and are not packed as closing ids."""
    long = " ".join(f"w{i}" for i in range(60))
    docs = documents(spark, [(1, long), (2, long), (3, None), (4, f"{long} {long}")])
    assert {r.doc_id for r in run(spark, "line_dedup", docs).collect()} == {1, 4}
    # only a blank between its halves is not in a string that document 1 holds
    assert {r.doc_id for r in run(spark, "suffix_dedup", docs).collect()} == {1}
