"""BPE against the vocabulary's own library."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stratamart.llm import bpe
from stratamart.llm.queries import op12_bpe
from tests.llm.helpers import SMALL, clashing, documents, empty, odd_rows, texts


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.vocabulary())


def ids_of(library, text):
    return np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def sha(data):
    return hashlib.sha256(data).hexdigest()


def test_query(spark, library):
    sources = texts(spark)
    rows = op12_bpe(spark, SMALL).collect()
    assert len(rows) == len(sources)
    for r in rows:
        ids = ids_of(library, sources[r.doc_id])
        back = library.decode(np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256) == (len(ids) // 4, sha(ids))
        assert r.decoded_sha256 == sha(back.encode())


def test_awkward_rows(spark, library):
    extra = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext", " " * 100_000, "ab" * 50_000, "\x1c\u0085　x"]
    rows = odd_rows() + [(20 + i, t) for i, t in enumerate(extra)]
    encoded = bpe.encode(clashing(documents(spark, rows)), back=True)
    assert encoded.filter(bpe.decoded(encoded["ids"]) != F.col("decoded")).isEmpty()
    found = encoded.select("doc_id", "ids", F.col("decoded").alias("text")).collect()
    wanted = [(i, ids_of(library, t or ""), t or "") for i, t in rows]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert sorted([(r.doc_id, bytes(r.ids), r.text) for r in found], key=key) == sorted(wanted, key=key)
    assert bpe.encode(empty(spark)).count() == 0


@pytest.mark.parametrize("place", ["a{}1", "{}. {}x"])
def test_classes_of_all_characters(library, place):
    """Letters, numbers and spaces are those of the library, of every code point."""
    encoder = bpe.loaded(bpe.vocabulary())
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(every), 4096):
        made = [place.replace("{}", c) for c in every[at : at + 4096]]
        for text, ids in zip(made, library.encode_batch(made, add_special_tokens=False)):
            assert encoder.encode(text) == np.array(ids.ids, "<u4").tobytes(), ascii(text)


FRAGMENTS = ["'s", "'S", " ", "  ", "\t", "\n", " ", "　", "<|endoftext|>", "<|endof", "a", "Zz", "é", "12", "²", "日", "🙂", "​"]


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=40), st.lists(st.sampled_from(FRAGMENTS), max_size=15).map("".join)))
def test_random_texts(library, text):
    encoder = bpe.loaded(bpe.vocabulary())
    assert encoder.encode(text) == ids_of(library, text)
    assert encoder.decode(encoder.encode(text)) == text


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 50256), max_size=8))
def test_any_ids_decode_alike(library, ids):
    """Also where the bytes are no whole characters."""
    encoder = bpe.loaded(bpe.vocabulary())
    assert encoder.decode(np.array(ids, "<u4").tobytes()) == library.decode(ids, skip_special_tokens=False)
