import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from stratamart.llm import packing
from stratamart.llm.queries import op4_packing
from tests.llm.helpers import SMALL, clashing, documents, empty, odd_rows, texts


def check(rows, sources):
    """Every id once, windows gapless, and little padding."""
    tokenizer = Tokenizer.from_file(packing.vocabulary())
    by_doc, by_window = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_window[r.sequence_id].append(r)
    for doc, text in sources.items():
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
        at = 0
        for r in sorted(by_doc[doc], key=lambda r: r.start):
            piece = np.array(ids[r.start : r.start + r.length], "<u4")
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(piece.tobytes())
            at += r.length
        assert at == len(ids)
    padding = 0
    for pieces in by_window.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
        padding += 0 if at & (at - 1) == 0 else 1024 - at
    assert padding == 0


def test_query(spark):
    check(op4_packing(spark, SMALL).collect(), texts(spark))


def test_awkward_rows(spark):
    rows = [r for r in odd_rows() if r[0] not in (None, 5, 6)] + [(20, " " * 400_000), (21, "<|endoftext|>"), (22, "a <|endoftext|> b")]
    check(packing.pack(clashing(documents(spark, rows))).collect(), {i: t or "" for i, t in rows})
    five = packing.pack(documents(spark, [(1, "a <|endoftext|> b")])).first()
    assert five.doc_tokens == 5
    every = packing.pack(documents(spark, odd_rows())).collect()
    assert sum(r.start == 0 for r in every) == len(odd_rows())
    assert packing.pack(empty(spark)).count() == 0


@pytest.mark.parametrize("most", [4096, 8])
def test_windows_stay_few_and_full(monkeypatch, most):
    monkeypatch.setattr(packing, "MAX_OPEN", most)
    draw = np.random.default_rng(1)
    sizes = [*draw.integers(1, 3000, 800), *[600] * 300, 1024, 2048]
    rows = [(i, np.arange(n, dtype="<u4")) for i, n in enumerate(sizes)]
    windows = list(packing.pack_stream(iter(rows), 1024))
    assert sum(w.fill for w in windows) == sum(sizes)
    assert all(w.fill == 1024 or w.fill & (w.fill - 1) == 0 for w in windows)
    assert len({w.number for w in windows}) == len(windows)
    seen = defaultdict(list)
    for w in windows:
        for doc, start, ids, total in w.pieces:
            assert (ids == np.arange(start, start + len(ids))).all() and total == sizes[doc]
            seen[doc].append((start, len(ids)))
    for doc, parts in seen.items():
        ends = [0]
        for start, n in sorted(parts):
            assert start == ends[-1]
            ends.append(start + n)
        assert ends[-1] == sizes[doc]


def test_level_choice_minimises_the_sum_of_squares():
    draw = np.random.default_rng(2)
    for _ in range(200):
        packer = packing.SumOfSquares(16)
        packer.counts[1:16] = draw.integers(0, 4, 15)
        size = int(draw.integers(1, 16))

        def total(level):
            counts = packer.counts.copy()
            if level:
                counts[level] -= 1
            if level + size < 16:
                counts[level + size] += 1
            return int((counts[1:16] ** 2).sum())

        able = [0, *[h for h in range(1, 17 - size) if packer.counts[h]]]
        assert total(packer.level_for(size)) == min(map(total, able))
