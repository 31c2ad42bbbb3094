import random

import numpy as np
import pytest

from stratamart.llm import jaccard
from tests.llm.helpers import clashing, documents, empty, odd_rows


def brute(rows, size=4, percent=85):
    """Set sizes and components by comparing all pairs."""
    sets = []
    for _, text in rows:
        words = (text or "").lower().split()
        width = min(size, len(words))
        sets.append({tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if words else set())
    least = [i for i, _ in rows]
    changed = True
    while changed:
        changed = False
        for a in range(len(rows)):
            for b in range(len(rows)):
                both = len(sets[a] & sets[b])
                if both and 100 * both >= percent * len(sets[a] | sets[b]) and least[b] < least[a]:
                    least[a], changed = least[b], True
    return sorted((i, len(s), c) for (i, _), s, c in zip(rows, sets, least))


def family(seed, members, edits):
    """Copies of a text with some words replaced."""
    draw = random.Random(seed)
    base = [f"w{draw.randrange(400)}" for _ in range(120)]
    out = []
    for _ in range(members):
        words = list(base)
        for _ in range(draw.randrange(edits + 1)):
            words[draw.randrange(len(words))] = f"x{draw.randrange(10_000)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("small_group,block", [(128, 256), (128, 12), (3, 4)])
def test_components_are_those_of_all_pairs(spark, monkeypatch, small_group, block):
    monkeypatch.setattr(jaccard, "SMALL_GROUP", small_group)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    made = family(1, 40, 8) + family(2, 25, 3) + family(3, 10, 12) + ["a b", "a b", "b a", "", "a b c d"]
    rows = list(enumerate(made))
    random.Random(5).shuffle(rows)
    found = jaccard.link(documents(spark, rows))
    assert sorted(map(tuple, found.collect())) == brute(rows)


def test_bitmaps_bound_the_overlap():
    draw = np.random.default_rng(3)
    for n, m in ((5, 9), (40, 300), (700, 690), (1, 1)):
        pool = draw.integers(0, 1 << 63, 800).astype(np.uint64)
        a, b = (np.unique(draw.choice(pool, k)) for k in (n, m))
        bound = jaccard.overlap_bound(jaccard.bitmap(a), len(a), jaccard.bitmap(b), len(b))
        assert jaccard.shared_count(a, b) == len(np.intersect1d(a, b)) <= bound


def test_awkward_rows(spark):
    rows = odd_rows()
    out = jaccard.link(clashing(documents(spark, rows))).collect()
    assert len(out) == len(rows)
    found = {(r.doc_id, r.n_shingles): r.component_id for r in out}
    assert found[(1, 0)] == 1 and found[(2, 0)] == 2
    assert all(c is None for (i, _), c in found.items() if i is None)
    assert {c for (i, n), c in found.items() if i in (4, 5)} == {4}
    kept = jaccard.keep_one(clashing(documents(spark, rows)))
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, 1, 2, 3, 4, 6, 6, 7]
    assert jaccard.link(empty(spark)).count() == 0


def test_near_copies_make_a_linear_number_of_tile_rows(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SMALL_GROUP", 16)
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    counted = []
    for name in ("_passing_in_tiles", "_links_in_tiles"):
        def counting(tiles, *others, inner=getattr(jaccard, name)):
            counted.append((inner.__name__, tiles.count()))
            return inner(tiles, *others)

        monkeypatch.setattr(jaccard, name, counting)
    rows = list(enumerate(family(4, 800, 1) + ["a b c d e f", "a b c d e g"]))
    found = {r.doc_id: r.component_id for r in jaccard.link(documents(spark, rows)).collect()}
    assert all(found[i] == 0 for i in range(800)) and found[800] == 800 and found[801] == 801
    # A block of 16 meets itself and at most 6 classes of other blocks.
    assert sum(n for name, n in counted if name == "_links_in_tiles") <= 3 * 800


def test_parts_that_first_tiles_leave_apart_are_still_joined(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SMALL_GROUP", 4)
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    made = [t for seed in range(6) for t in family(1, 12, 9 + seed)] + family(1, 30, 14)
    head = " ".join(f"common{i}" for i in range(30))
    rows = [(i, f"{head} {t}") for i, t in enumerate(made)]
    random.Random(7).shuffle(rows)
    found = jaccard.link(documents(spark, rows))
    assert sorted(map(tuple, found.collect())) == brute(rows)


def test_a_common_passage_brings_few_together(spark, monkeypatch):
    """2,000 unlike documents that share a passage: at most one pair each, and no tile."""
    counted = {"pairs": 0, "tiles": 0}
    passing, tiles = jaccard._passing, jaccard._passing_in_tiles

    def counting_pairs(pairs, *others):
        counted["pairs"] += pairs.count()
        return passing(pairs, *others)

    def counting_tiles(rows, *others):
        counted["tiles"] += rows.count()
        return tiles(rows, *others)

    monkeypatch.setattr(jaccard, "_passing", counting_pairs)
    monkeypatch.setattr(jaccard, "_passing_in_tiles", counting_tiles)
    passage = " ".join(f"shared{i}" for i in range(20))
    draw = random.Random(11)
    rows = [(i, f"{passage} " + " ".join(f"w{draw.randrange(10**9)}" for _ in range(100))) for i in range(2000)]
    rows += [(2000 + i, text) for i, (_, text) in enumerate(rows[:50])]
    found = {r.doc_id: r.component_id for r in jaccard.link(documents(spark, rows)).collect()}
    assert all(found[i] == i % 2000 for i in found)
    assert counted["pairs"] <= 2000 and counted["tiles"] == 0
