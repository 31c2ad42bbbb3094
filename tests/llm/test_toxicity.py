import zlib

import numpy as np

from stratamart.llm import toxicity
from stratamart.llm.queries import op6_toxicity
from tests.conftest import TESTDATA
from tests.llm.helpers import clashing, documents, empty, odd_rows


def test_held_out_accuracy(spark):
    sf_dir = f"{TESTDATA}/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = op6_toxicity(spark, sf_dir).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)
    told = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    caught = sum(t and p for t, p in told) / sum(t for t, _ in told)
    blamed = sum(p and not t for t, p in told) / sum(not t for t, _ in told)
    assert caught > 0.85 and blamed < 0.01


def test_pairs_of_terms_are_learnt():
    """Toxic only where two terms meet, which no sum of their weights can separate."""
    draw = np.random.default_rng(0)
    sets, labels = [], []
    for _ in range(1500):
        insult, group = draw.integers(0, 2, 2)
        filler = draw.choice(np.arange(10, 40), 4, replace=False)
        chosen = [*filler, *([1] * insult), *([2] * group)]
        sets.append(np.unique(np.array(chosen, np.uint32)))
        labels.append(float(insult and group))
    labels = np.array(labels)
    model = toxicity.fit(sets, labels, rounds=300)
    told = model.logits([model.known(s) for s in sets]) > 0
    assert (told == (labels > 0)).mean() > 0.98


def test_awkward_rows(spark):
    docs = clashing(documents(spark, odd_rows()))
    labels = spark.createDataFrame(
        [(4, 1, 1), (5, 1, 0), (5, 0, 1), (6, None, None), (None, 0, 1), (99, 0, 1)],
        "doc_id long, quality int, toxic int",
    )
    for given in (labels, labels.limit(0)):
        model = toxicity.train(docs, given)
        rows = toxicity.score(docs, model).collect()
        assert len(rows) == len(odd_rows()) and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score(empty(spark), model).count() == 0
    assert toxicity.train(empty(spark), labels).hashes.size == 0
