from stratamart.llm import quality
from tests.llm.helpers import clashing, documents, empty, odd_rows

GOOD = " ".join(f"Plain{i}" if i % 9 == 0 else f"words{i}" for i in range(80))


def rows_of(spark):
    return documents(
        spark,
        [
            (1, GOOD),
            (2, "too short"),
            (3, "same words again " * 40),
            (4, " | ".join(GOOD.split())),
            (5, GOOD.upper()),
            (6, "\n".join(["one line with many different words " + GOOD] + ["short"] * 9)),
        ],
    )


def test_policies_and_ablation(spark):
    ledger = quality.ledger(rows_of(spark)).cache()
    failed = {r.doc_id: r.failures for r in ledger.collect()}
    bits = {rule.name: rule.mask for rule in quality.RULES}
    assert failed[1] == 0 and failed[2] == bits["few_words"] and failed[5] == bits["shouting"]
    assert failed[3] == bits["repeated_words"] and failed[4] == bits["many_symbols"]
    assert failed[6] == bits["repeated_lines"]
    kept = {v: sorted(r.doc_id for r in ledger.filter(quality.kept(v)).collect()) for v in quality.POLICIES}
    assert kept == {"base": [1, 4, 5, 6], "v1": [1, 5], "v2": [1]}
    effect = {r.rule: tuple(r)[1:] for r in quality.ablation(ledger, "v1").collect()}
    assert effect["many_symbols"] == (1, 1, 3) and effect["few_words"] == (1, 1, 3)
    assert quality.ablation(quality.ledger(empty(spark))).count() == 0


def test_repeated_words_cover_whole_windows():
    words = "a b c d a b c e a b c".split()
    assert quality._repeat_words(words) == 9
    assert quality._repeat_words(["x"] * 5) == 5
    assert quality._repeat_words("a b c d".split()) == 0


def test_awkward_rows(spark):
    docs = clashing(documents(spark, odd_rows() + [(1, GOOD)]))
    assert quality.ledger(docs).count() == len(odd_rows()) + 1
    kept = quality.filter_documents(docs)
    assert kept.columns == docs.columns
    assert {(r.doc_id, r.text[:5]) for r in kept.collect()} == {(4, "word0"), (5, "word0"), (1, "Plain")} - (
        set() if quality.ledger(docs).filter("doc_id = 4").first().failures == 0 else {(4, "word0"), (5, "word0")}
    )
    assert quality.filter_documents(empty(spark)).count() == 0
