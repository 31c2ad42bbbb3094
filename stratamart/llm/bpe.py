"""Byte-level BPE: texts to ids by merge ranks, and ids back to texts.

A text is cut at the vocabulary's added tokens, then into words by its pattern. A word starts
as a doubly linked list of its bytes' symbols. A heap holds every neighbouring pair that has a
merge, ordered by rank and place; the least is merged, its new neighbours are pushed, and
entries whose pair has changed since are skipped. A word of n bytes costs n log n, however
long it is. Words up to ``KNOWN_LENGTH`` characters are remembered by the task, forgotten when
there are ``KNOWN_WORDS`` of them, which changes the speed and not the ids.

``ids`` are binary: unsigned 32-bit integers, little-endian. Decoding concatenates the
vocabulary's strings, turned back into bytes.

One pass and no shuffle; a lost task encodes its rows again with the same result.

Defined cases: a null or empty text has no ids (a null ``ids`` decodes to null); a null id is
carried; repeated rows are encoded each on their own; an empty table gives no rows. Only the
id and the text are read, so other columns cannot clash. Texts are encoded whole.
"""

import json
import unicodedata
from collections.abc import Iterator
from functools import cache
from heapq import heapify, heappop, heappush
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from stratamart.llm.packing import PATTERN, _printable_bytes, vocabulary

KNOWN_LENGTH = 64
KNOWN_WORDS = 500_000
#: Bits of a symbol in a pair, and of a place in an entry of the heap.
SHIFT, SHIFT_PLACE = 24, 40
PLACES = (1 << SHIFT_PLACE) - 1
#: Bytes of ids handed to Spark at once.
OUT_BYTES = 4 << 20
#: A character that is neither letter, number nor space; private use.
OTHER = "\ue000"


@cache
def _too_new() -> dict[int, str]:
    """Letters and numbers that the pattern engine knows but the vocabulary's library does not.

    The library's classes are those of the Unicode release in ``unicodedata``; the pattern
    engine's are of a later one.
    """
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    found = regex.findall(r"[\p{L}\p{N}]", every)
    return {ord(c): OTHER for c in found if unicodedata.category(c) == "Cn"}


class Bpe:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, alphabet = spec["model"]["vocab"], _printable_bytes()
        added = {token["content"]: token["id"] for token in spec["added_tokens"]}
        self.symbols = [0] * 256
        for char, byte in alphabet.items():
            self.symbols[byte] = vocab[char]
        # rank of a pair of symbols, and the symbol that each rank's merge makes
        self.ranks: dict[int, int] = {}
        self.made: list[int] = []
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.ranks[vocab[left] << SHIFT | vocab[right]] = rank
            self.made.append(vocab[left + right])
        self.strings = [b""] * (1 + max(*vocab.values(), *added.values()))
        for piece, number in vocab.items():
            if piece not in added:
                self.strings[number] = bytes(alphabet[c] for c in piece)
        for content, number in added.items():
            self.strings[number] = content.encode()
        self.packed = [pack("<I", number) for number in range(len(self.strings))]
        self.added = {content: pack("<I", number) for content, number in added.items()}
        longest_first = sorted(added, key=len, reverse=True)
        self.cuts = regex.compile("|".join(map(regex.escape, longest_first))) if added else None
        self.words = regex.compile(PATTERN)
        self.odd = frozenset(map(chr, _too_new()))
        self.known: dict[str, bytes] = {}

    def merge(self, ids: list[int]) -> list[int]:
        """The symbols of one word after all merges, least rank first, leftmost of equals."""
        rank_of, made = self.ranks.get, self.made
        n = len(ids)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        # the rank of the pair that begins at a place now, -1 for none
        now = [rank_of(a << SHIFT | b, -1) for a, b in zip(ids, ids[1:])]
        heap = [rank << SHIFT_PLACE | at for at, rank in enumerate(now) if rank >= 0]
        now.append(-1)
        heapify(heap)
        while heap:
            entry = heappop(heap)
            at, rank = entry & PLACES, entry >> SHIFT_PLACE
            if now[at] != rank:
                continue  # stale
            gone = after[at]
            ids[at] = new = made[rank]
            ids[gone] = now[gone] = -1
            after[at] = beyond = after[gone]
            if beyond < n:
                before[beyond] = at
                now[at] = rank = rank_of(new << SHIFT | ids[beyond], -1)
                if rank >= 0:
                    heappush(heap, rank << SHIFT_PLACE | at)
            else:
                now[at] = -1
            if (ahead := before[at]) >= 0:
                now[ahead] = rank = rank_of(ids[ahead] << SHIFT | new, -1)
                if rank >= 0:
                    heappush(heap, rank << SHIFT_PLACE | ahead)
        return [i for i in ids if i >= 0]

    def word(self, word: str) -> bytes:
        packed = b"".join([self.packed[i] for i in self.merge([self.symbols[byte] for byte in word.encode()])])
        if len(word) <= KNOWN_LENGTH:
            if len(self.known) == KNOWN_WORDS:
                self.known.clear()
            self.known[word] = packed
        return packed

    def split(self, text: str) -> list[str]:
        """The words of a text without added tokens."""
        if not text.isascii() and not self.odd.isdisjoint(text):
            return [text[slice(*m.span())] for m in self.words.finditer(text.translate(_too_new()))]
        return self.words.findall(text)

    def plain(self, text: str) -> bytes:
        known = self.known.get
        return b"".join([known(word) or self.word(word) for word in self.split(text)])

    def encode(self, text: str) -> bytes:
        out, start = [], 0
        for cut in self.cuts.finditer(text) if self.cuts else ():
            out += self.plain(text[start : cut.start()]), self.added[cut.group()]
            start = cut.end()
        out.append(self.plain(text[start:] if start else text))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        numbers = np.frombuffer(ids, "<u4").tolist()
        return b"".join(map(self.strings.__getitem__, numbers)).decode("utf-8", "replace")


@cache
def loaded(path: str) -> Bpe:
    return Bpe(path)


def encode(docs: DataFrame, vocab: str | None = None, back: bool = False) -> DataFrame:
    """``doc_id, ids`` of every row; with ``back`` also ``decoded``, the text of these ids.

    Rows are given back some megabytes at a time.
    """
    path = vocab or vocabulary()
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, ids binary" + (", decoded string" if back else "")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)

        def rows(batch: pa.RecordBatch, start: int, ids: list[bytes]) -> pa.RecordBatch:
            arrays = {"doc_id": batch.column(0).slice(start, len(ids)), "ids": pa.array(ids, pa.binary())}
            if back:
                arrays["decoded"] = pa.array(map(bpe.decode, ids), pa.string())
            return pa.RecordBatch.from_pydict(arrays)

        for batch in batches:
            start, ids, size = 0, [], 0
            for text in batch.column(1):
                ids.append(bpe.encode(text.as_py() or ""))
                size += len(ids[-1])
                if size >= OUT_BYTES:
                    yield rows(batch, start, ids)
                    start, ids, size = start + len(ids), [], 0
            if ids:
                yield rows(batch, start, ids)

    return docs.select("doc_id", "text").mapInArrow(task, schema)


def decoded(ids: Column, vocab: str | None = None) -> Column:
    """The text of a column of ids; unknown ids raise."""
    path = vocab or vocabulary()

    @F.arrow_udf(StringType())
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = loaded(path)
        for batch in batches:
            yield pa.array([None if v is None else bpe.decode(v) for v in batch.to_pylist()], pa.string())

    return text(ids)
