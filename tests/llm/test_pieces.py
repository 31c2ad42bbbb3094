import pytest
from pyspark.sql import functions as F

from stratamart.llm import pieces
from stratamart.llm.queries import op10_sentencepiece
from tests.llm.helpers import SMALL, clashing, documents, empty, odd_rows, texts


@pytest.fixture(scope="module")
def model():
    return pieces.Pieces(pieces.vocabulary())


def brute(model, text):
    """All segmentations of a short text with their scores."""
    line = pieces.SPACE + text.replace(pieces.SPACE, pieces.OWN).replace(" ", pieces.SPACE)
    found = {}

    def walk(at, ids, score):
        if at == len(line):
            found[tuple(ids)] = score
            return
        for end in range(at + 1, min(len(line), at + model.longest) + 1):
            if line[at:end] in model.scores:
                number, more = model.scores[line[at:end]]
                walk(end, [*ids, number], score + more)
        if line[at] not in model.scores:
            numbers, more = model.spell(line[at])
            walk(at + 1, ids + numbers, score + more)

    walk(0, [], 0.0)
    return found


def segmentations(encoded):
    ids, score, others = encoded
    out = [(score, tuple(ids))]
    for total, changes in others:
        made = list(ids)
        for at, gone, instead in reversed(changes):
            made[at : at + gone] = instead
        out.append((total, tuple(made)))
    return out


@pytest.mark.parametrize(
    "text",
    ["a", "the cat", "ab  c", " x", "\n", "a\nb\tc", "ü日 x", "hello wor", "\u2581 ▁a", "12:30!!", "\x00a\x00", "ÿ\ue000"],
)
def test_n_best_of_all(model, text):
    every = brute(model, text)
    found = segmentations(model.encode(text))
    assert [s for s, _ in found] == sorted(every.values(), reverse=True)[: model.n_best]
    assert all(every[ids] == s for s, ids in found) and len(set(found)) == len(found)
    assert model.decode(found[0][1]) == text


def test_long_parts_go_by_search_alone(model):
    text = "unbroken" * 30
    found = segmentations(model.encode(text))
    assert model.decode(found[0][1]) == text and found[0][0] >= found[1][0] >= found[-1][0]


def test_query_round_trip_and_alternatives(spark, model):
    rows = op10_sentencepiece(spark, SMALL).collect()
    source = texts(spark)
    assert len(rows) == len(source) and all(r.round_trip and r.n_pieces == len(r.ids) for r in rows)
    named = {number: score for number, score in model.scores.values()}
    named |= {number: score for number, score in model.bytes.values()}
    for r in rows[:50]:
        assert r.score == sum(named[i] for i in r.ids)
        for other in r.others:
            ids = list(r.ids)
            for c in reversed(other.changes):
                ids[c["at"] : c["at"] + c["gone"]] = c["ids"]
            assert other.score == sum(named[i] for i in ids) <= r.score
            assert model.decode(ids) == source[r.doc_id]


def test_awkward_rows(spark, model):
    docs = clashing(documents(spark, odd_rows()))
    out = pieces.encode(docs)
    assert out.filter("exact").count() == len(odd_rows())
    decoded = out.select("doc_id", "ids", "others", pieces.decode(F.col("ids")).alias("back"))
    assert sorted((r.doc_id or 0, r.back) for r in decoded.collect()) == sorted(
        (i or 0, t or "") for i, t in odd_rows()
    )
    other = decoded.filter("size(others) > 0").select(
        "ids", "others", pieces.apply_changes(F.col("ids"), F.col("others")[0]["changes"]).alias("made")
    )
    for r in other.collect():
        ids = list(r.ids)
        for c in reversed(r.others[0].changes):
            ids[c["at"] : c["at"] + c["gone"]] = c["ids"]
        assert ids == r.made
    assert pieces.encode(empty(spark)).count() == 0
