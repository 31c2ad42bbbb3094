"""Collocations: frequent phrases of a corpus, counted with double-array tries.

Everything is per language. ``mine`` works in passes over the texts:

1. *Support*, once per length: a task gives hashed phrases with counts that stop at the least
   count wanted, packed in arrays by range of hashes; their sum says whether a phrase may be frequent, not how often it occurs. A
   phrase is only tried if all its parts may be frequent (Apriori), which tasks look up in a
   bitmap of ``2 ** BITMAP_BITS`` bits. Bits and hashes that coincide only let more through.
2. *Counts*, in one pass more: a task gives the texts of the phrases that may be frequent, each
   once with its count. They are dealt to shards by their keys, and so are the keys that have
   support; phrases without support go there.
3. A task per shard builds the double array of its candidates, about ``SHARD`` at most. numpy
   moves the states of all phrases given on together, digit by digit, and sums their counts by
   the state that accepts them.

The texts are read ``longest + 1`` times, whatever the number of candidates, and no task holds
more than its shard of them.

A word is a 64-bit hash in tasks. Two words of one shard with equal hashes raise; that another
word of the corpus has the hash of a given shard's word has a chance of shard size / 2**64.
Phrases with equal keys are told apart by their words.

Counts, scores and ranks are exact.

Defined cases: a null language is ``und``, a null text is empty; texts without words add
nothing; repeated rows count each; ties are broken by the phrase; an empty table gives no
rows. Only the language and the text are read, so other columns cannot clash. Texts are read
whole, each in one task.
"""

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from stratamart.llm.common import Steps, partitions_for

LEAST, LONGEST, TOP = 10, 3, 2000
BITMAP_BITS = 26
SHARD = 1 << 18
CHUNK_BYTES = 4 << 20
#: Bytes of phrases that a task holds to sum their counts before it gives them.
HELD_BYTES = 32 << 20
#: Words of more bytes are hashed one by one.
LONG_WORD = 64

# Byte classes: 0 in words, 1 between words, 2 between pieces.
_CLASS = np.zeros(256, np.uint8)
_CLASS[[32, 9]] = 1
_CLASS[[*b".,;:!?", *range(10, 14)]] = 2
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_BYTE = np.random.default_rng(13).integers(1, 2**63, 256, np.uint64) | np.uint64(1)
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(keys: np.ndarray) -> np.ndarray:
    keys = (keys ^ (keys >> np.uint64(30))) * _B
    keys = (keys ^ (keys >> np.uint64(27))) * _C
    return keys ^ (keys >> np.uint64(31))


def followed(keys: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Keys of phrases that are one word longer."""
    return mixed(keys * _A + words)


def text_key(text: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little")


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of words given by their places, byte column by byte column."""
    lengths = ends - starts
    hashes = lengths.astype(np.uint64)
    rows = np.argsort(np.minimum(lengths, 255).astype(np.uint8), kind="stable")
    rows = rows[: np.count_nonzero(lengths <= LONG_WORD)]
    held, left, at = hashes[rows], lengths[rows], starts[rows]
    first = 0
    for byte in range(int(left[-1]) if len(left) else 0):
        first = int(np.searchsorted(left, byte, "right"))
        held[first:] = held[first:] * _A + _BYTE[data[at[first:] + byte]]
    hashes[rows] = held
    for row in np.flatnonzero(lengths > LONG_WORD):
        hashes[row] = text_key(data[starts[row] : ends[row]].tobytes())
    return mixed(hashes)


class Chunk:
    """The words of some texts in arrays."""

    def __init__(self, texts: list[str], langs: list[str]):
        raw = [text.encode() for text in texts]
        self.data = b"\n".join(raw).translate(_LOWER)
        self.bytes = np.frombuffer(self.data, np.uint8)
        kinds = _CLASS[self.bytes]
        inside = np.zeros(len(kinds) + 2, bool)
        inside[1:-1] = kinds == 0
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.starts, self.ends = edges[::2].copy(), edges[1::2].copy()
        #: whether the word i + 1 follows the word i in one piece
        self.joined = np.ones(len(self.starts) + 1, bool)
        self.joined[np.searchsorted(self.starts, np.flatnonzero(kinds == 2)) - 1] = False
        self.joined = self.joined[:-1]
        self.joined[-1:] = False
        self.langs, codes = np.unique(np.array(langs, object), return_inverse=True)
        ends = np.cumsum([len(r) + 1 for r in raw])
        self.lang = np.repeat(codes, np.diff(np.searchsorted(self.starts, ends), prepend=0))
        salts = np.array([text_key(lang.encode()) for lang in self.langs], np.uint64)
        self.words = mixed(word_hashes(self.bytes, self.starts, self.ends) ^ salts[self.lang])

    def keys(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """First words and keys of all phrases of a length."""
        at = np.flatnonzero(self.run(length))
        keys = self.words[at]
        for step in range(1, length):
            keys = followed(keys, self.words[at + step])
        return at, keys

    def run(self, length: int) -> np.ndarray:
        """Whether a phrase of that length starts at a word."""
        ok = np.ones(len(self.words), bool)
        for step in range(length - 1):
            ok[: len(ok) - step] &= self.joined[step:]
            ok[len(ok) - step :] = False
        return ok

    def texts(self, at: np.ndarray, length: int) -> pa.StringArray:
        """The phrases of a length that start at words, joined by single spaces."""
        words = at[:, None] + np.arange(length)
        starts, sizes = self.starts[words].ravel(), (self.ends - self.starts)[words]
        sizes[:, :-1] += 1  # a byte for the space
        offsets = np.append(0, np.cumsum(sizes.sum(axis=1))).astype(np.int32)
        sizes = sizes.ravel()
        ends = np.cumsum(sizes)
        out = self.bytes[np.arange(offsets[-1]) + np.repeat(starts - (ends - sizes), sizes)]
        spaces = np.ones((len(at), length), bool)
        spaces[:, -1] = False
        out[ends[spaces.ravel()] - 1] = 32
        return pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(out))


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
    """Texts of ``lang, text`` rows, some at a time."""
    texts, langs, size = [], [], 0
    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1)):
            if text := text.as_py():
                texts.append(text)
                langs.append(lang.as_py())
                size += len(text)
            if size >= CHUNK_BYTES:
                yield Chunk(texts, langs)
                texts, langs, size = [], [], 0
    if texts:
        yield Chunk(texts, langs)


def has(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    bits = keys & np.uint64(8 * len(bitmap) - 1)
    return (bitmap[bits >> np.uint64(3)] >> (bits & np.uint64(7)).astype(np.uint8)) & 1 == 1


def possible(chunk: Chunk, length: int, bitmaps: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Places and keys of phrases all of whose shorter parts may be frequent."""
    at, keys = chunk.keys(length)
    if length > 1:
        before, parts = chunk.keys(length - 1)
        frequent = np.zeros(len(chunk.words) + 1, bool)
        frequent[before] = has(bitmaps[length - 2], parts)
        ok = frequent[at] & frequent[at + 1]
        at, keys = at[ok], keys[ok]
    return at, keys


def support(texts: DataFrame, length: int, bitmaps, least: int) -> DataFrame:
    """Keys of phrases that may occur ``least`` times or more.

    A task gives the keys of some texts in sorted arrays, one per range of keys; ranges are
    brought together and summed as arrays.
    """
    ranges = 2 * partitions_for(texts.sparkSession)
    edges = np.array([i * (1 << 64) // ranges for i in range(1, ranges)], np.uint64)
    stopped = np.min_scalar_type(least)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            _, keys = possible(chunk, length, [b.value for b in bitmaps])
            keys, counts = np.unique(keys, return_counts=True)
            counts = np.minimum(counts, least).astype(stopped)
            cuts = [0, *np.searchsorted(keys, edges).tolist(), len(keys)]
            some = [(i, a, b) for i, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]
            yield pa.RecordBatch.from_pydict(
                {
                    "range": pa.array([i for i, _, _ in some], pa.int32()),
                    "keys": pa.array([keys[a:b].tobytes() for _, a, b in some], pa.binary()),
                    "counts": pa.array([counts[a:b].tobytes() for _, a, b in some], pa.binary()),
                }
            )

    def summed(part: pa.Table) -> pa.Table:
        keys = np.frombuffer(b"".join(part["keys"].to_pylist()), np.uint64)
        counts = np.frombuffer(b"".join(part["counts"].to_pylist()), stopped)
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order].astype(np.int64)
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        heavy = keys[first][np.add.reduceat(counts, first) >= least]
        return pa.table({"key": pa.array(heavy.view(np.int64))})

    given = texts.mapInArrow(task, "range int, keys binary, counts binary")
    return given.groupBy("range").applyInArrow(summed, "key long")


def bitmap(keys: DataFrame, bits: int) -> np.ndarray:
    """The keys' low bits as a bitmap; its size does not depend on the keys."""
    low = F.col("key").bitwiseAND(F.lit((1 << bits) - 1))
    one = F.expr("shiftleft(1L, int(key & 63))")
    rows = (
        keys.select(F.shiftright(low, 6).alias("word"), one.alias("bit"))
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
    )
    found = rows.toArrow()
    words = np.zeros(1 << (bits - 6), np.int64)
    words[found["word"].to_numpy()] = found["bits"].to_numpy()
    return words.view(np.uint8)


def distinct(chunk: Chunk, at: np.ndarray, keys: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """A place of each different phrase of those that start at words, and how many are equal to it."""
    _, first, which, n = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
    for step in range(length):
        words = chunk.words[at + step]
        if (words != words[first][which]).any():  # different phrases have one key
            rows = chunk.words[at[:, None] + np.arange(length)]
            _, first, n = np.unique(rows, axis=0, return_index=True, return_counts=True)
            break
    return first, n


def found_in(chunk: Chunk, bitmaps: list[np.ndarray]) -> pa.Table:
    """``key, n, lang, phrase`` of what may be frequent, phrases of every length."""
    parts = []
    for length, bits in enumerate(bitmaps, 1):
        at, keys = possible(chunk, length, bitmaps)
        ok = has(bits, keys)
        at, keys = at[ok], keys[ok]
        first, n = distinct(chunk, at, keys, length)
        langs = pa.array(chunk.langs, pa.string()).take(pa.array(chunk.lang[at[first]]))
        columns = [pa.array(keys[first]), pa.array(n.astype(np.int64)), langs, chunk.texts(at[first], length)]
        parts.append(pa.Table.from_arrays(columns, ["key", "n", "lang", "phrase"]))
    return pa.concat_tables(parts)


def merged(parts: list[pa.Table]) -> pa.Table:
    """Equal phrases of some tables as one row with the sum of their counts."""
    every = pa.concat_tables(parts).combine_chunks()
    keys, first, which = np.unique(every["key"].to_numpy(), return_index=True, return_inverse=True)
    one = every.take(pa.array(first))
    if not one.select(["lang", "phrase"]).take(pa.array(which)).equals(every.select(["lang", "phrase"])):
        return every  # different phrases have one key; their shard tells them apart
    n = np.zeros(len(keys), np.int64)
    np.add.at(n, which, every["n"].to_numpy())
    return one.set_column(1, "n", pa.array(n))


GIVEN = "shard int, lang string, phrases string, counts binary"


def given(shards, langs, phrases, counts) -> pa.RecordBatch:
    columns = [pa.array(shards, pa.int32()), pa.array(langs, pa.string()), phrases, pa.array(counts, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["shard", "lang", "phrases", "counts"])


def dealt(found: pa.Table, shards: int) -> pa.RecordBatch:
    """A row per shard and language: phrases in lines, and their counts."""
    shard = found["key"].to_numpy().view(np.int64) % shards
    lang = found["lang"].combine_chunks().dictionary_encode()
    codes = lang.indices.to_numpy()
    order = np.lexsort((codes, shard))
    shard, codes = shard[order], codes[order]
    starts = np.flatnonzero(np.append(True, (shard[1:] != shard[:-1]) | (codes[1:] != codes[:-1]))[: len(order)])
    cuts = np.append(starts, len(order))
    lines = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), found["phrase"].combine_chunks().take(pa.array(order)))
    n = found["n"].to_numpy()[order].astype(np.uint32)  # a task's texts hold fewer than 2**32 words
    counts = [n[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
    return given(shard[starts], lang.dictionary.take(pa.array(codes[starts])), pc.binary_join(lines, "\n"), counts)


# --- the double array ---------------------------------------------------------------------

ALPHABET_BITS = 6
_LOW = [np.uint64(sum(1 << i for i in range(64) if not i >> t & 1)) for t in range(6)]


def moved(masks: np.ndarray, offset: int) -> np.ndarray:
    """Sets of labels, as bits, with every label changed by an exclusive or."""
    for t in range(6):
        if offset >> t & 1:
            step = np.uint64(1 << t)
            masks = ((masks & _LOW[t]) << step) | ((masks >> step) & _LOW[t])
    return masks


def placed(masks: np.ndarray) -> tuple[np.ndarray, int]:
    """A base for every node such that no two nodes' children share a slot, and the slots used.

    Children of a node lie in one block of 64 slots, at ``base ^ label``. Nodes with most
    children come first; each round offers every block to one node. Slot 0 is the root's.
    """
    draw = np.random.default_rng(1)
    sizes = np.bitwise_count(masks)
    bases = np.zeros(len(masks), np.int64)
    used = np.ones(1, np.uint64)
    for size in range(64, 1, -1):
        todo, rounds = np.flatnonzero(sizes == size), 0
        room = np.flatnonzero(np.bitwise_count(used) <= 64 - size)
        while len(todo):
            if rounds == 24 or not len(room):
                more = max(1, len(todo) * size // 40)
                room = np.arange(len(used), len(used) + more)
                used = np.append(used, np.zeros(more, np.uint64))
                rounds = 0
            blocks = np.roll(room, int(draw.integers(len(room))))[: len(todo)]
            offset = int(draw.integers(64))
            tried = todo[: len(blocks)]
            wanted = moved(masks[tried], offset)
            ok = (used[blocks] & wanted) == 0
            used[blocks[ok]] |= wanted[ok]
            bases[tried[ok]] = blocks[ok] * 64 + offset
            todo = np.concatenate([tried[~ok], todo[len(blocks) :]])
            rounds += 1
    single = np.flatnonzero(sizes == 1)  # these fit any free slot
    free = np.flatnonzero(np.unpackbits(~used.view(np.uint8), bitorder="little"))
    missing = len(single) - len(free)
    if missing > 0:
        blocks = -(-missing // 64)
        free = np.append(free, np.arange(len(used) * 64, (len(used) + blocks) * 64))
        used = np.append(used, np.zeros(blocks, np.uint64))
    labels = np.bitwise_count(masks[single] - np.uint64(1)).astype(np.int64)
    bases[single] = free[: len(single)] ^ labels
    return bases, len(used) * 64


@dataclass
class DoubleArray:
    """A trie of phrases. A word is ``digits`` labels of ``ALPHABET_BITS`` bits, its code's."""

    words: np.ndarray  # sorted word keys; a word's code is its place
    digits: int
    base: np.ndarray
    check: np.ndarray
    accepts: np.ndarray

    def code(self, words: np.ndarray) -> np.ndarray:
        """Codes of words, -1 for words that no phrase of this trie has."""
        if not len(self.words):
            return np.full(len(words), -1, np.int64)
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return np.where(self.words[at] == words, at, -1)

    def advance(self, states: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """States after one more word, of those that go on, and which these are."""
        kept = np.arange(len(states))
        for digit in range(self.digits - 1, -1, -1):
            label = (codes[kept] >> (ALPHABET_BITS * digit)) & 63
            after = self.base[states] ^ label.astype(np.int32)
            ok = self.check[after] == states
            states, kept = after[ok], kept[ok]
        return states, kept

    @classmethod
    def build(cls, codes: np.ndarray, words: np.ndarray) -> tuple["DoubleArray", np.ndarray]:
        """The trie of phrases given as rows of codes (-1: none), and each phrase's state."""
        digits = max(1, -(-max(1, len(words) - 1).bit_length() // ALPHABET_BITS))
        order = np.lexsort(codes.T[::-1])
        codes = codes[order]
        n, longest = codes.shape
        labels = np.full((n, longest * digits), 255, np.uint8)
        for word in range(longest):
            for digit in range(digits):
                part = (codes[:, word] >> (ALPHABET_BITS * (digits - 1 - digit))) & 63
                labels[:, word * digits + digit] = np.where(codes[:, word] >= 0, part, 255)
        lengths = (codes >= 0).sum(axis=1) * digits
        differs = np.zeros(n, bool)
        differs[:1] = True
        row_node = np.zeros(n, np.int64)  # the node a row's phrase has reached so far
        end = np.zeros(n, np.int64)
        parents, marks, nodes = [], [], 1
        for level in range(longest * digits):
            differs[1:] |= labels[1:, level] != labels[:-1, level]
            inside = lengths > level
            new = differs & inside
            parents.append(row_node[new])
            marks.append(labels[new, level].astype(np.int64))
            row_node = np.where(inside, nodes - 1 + np.cumsum(new), row_node)
            nodes += int(new.sum())
            end = np.where(lengths == level + 1, row_node, end)
        parent, label = np.concatenate(parents), np.concatenate(marks)
        masks = np.zeros(nodes, np.uint64)
        np.bitwise_or.at(masks, parent, np.uint64(1) << label.astype(np.uint64))
        inner = np.flatnonzero(masks)
        bases, slots = np.zeros(nodes, np.int64), 64
        if len(inner):
            bases[inner], slots = placed(masks[inner])
        slot = np.zeros(nodes, np.int64)
        slot[1:] = bases[parent] ^ label
        base, check = np.zeros(slots, np.int32), np.full(slots, -1, np.int32)
        accepts = np.zeros(slots, bool)
        base[slot] = bases
        check[slot[1:]] = slot[parent]
        accepts[slot[end]] = n > 0
        states = np.empty(n, np.int64)
        states[order] = slot[end]
        return cls(words, digits, base, check, accepts), states

    def to_bytes(self) -> list[bytes]:
        parts = self.words, np.array([self.digits], np.int64), self.base, self.check, self.accepts
        return [p.tobytes() for p in parts]

    @classmethod
    def from_bytes(cls, parts: list[bytes]) -> "DoubleArray":
        words, digits, base, check, accepts = parts
        return cls(
            np.frombuffer(words, np.uint64),
            int(np.frombuffer(digits, np.int64)[0]),
            np.frombuffer(base, np.int32),
            np.frombuffer(check, np.int32),
            np.frombuffer(accepts, bool),
        )


def word_keys(langs, words) -> np.ndarray:
    """Keys of words as ``Chunk.words`` has them."""
    raw = [w.encode() for w in words]
    data = np.frombuffer(b" ".join(raw), np.uint8)
    lengths = np.array([len(r) for r in raw], np.int64)
    starts = np.cumsum(lengths + 1) - lengths - 1
    salts = {lang: text_key(lang.encode()) for lang in set(langs)}
    return mixed(word_hashes(data, starts, starts + lengths) ^ np.array([salts[lang] for lang in langs], np.uint64))


def trie_of(phrases: pd.DataFrame, longest: int) -> tuple[DoubleArray, np.ndarray]:
    """The trie of ``lang, phrase`` rows and the state of each."""
    split = [p.split(" ") for p in phrases["phrase"]]
    words = sorted({(lang, w) for lang, ws in zip(phrases["lang"], split) for w in ws})
    keys = word_keys(*zip(*words))
    order = np.argsort(keys)
    if len(keys) > 1 and (np.diff(keys[order].view(np.int64)) == 0).any():
        raise ValueError("two words have one hash")
    number = {words[i]: at for at, i in enumerate(order.tolist())}
    codes = np.full((len(split), longest), -1, np.int64)
    for row, (lang, ws) in enumerate(zip(phrases["lang"], split)):
        codes[row, : len(ws)] = [number[lang, w] for w in ws]
    return DoubleArray.build(codes, keys[order])


def accepted(trie: DoubleArray, chunk: Chunk, at: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The states that accept phrases given by their first words and lengths, or -1."""
    codes = trie.code(chunk.words)
    states, rows = np.zeros(len(at), np.int32), np.arange(len(at))
    for step in range(int(lengths.max(initial=0))):
        rows = rows[lengths[rows] > step]
        known = rows[codes[at[rows] + step] >= 0]
        after, kept = trie.advance(states[known], codes[at[known] + step])
        states[rows] = -1
        rows = known[kept]
        states[rows] = after
    return np.where((states >= 0) & trie.accepts[states], states, -1)


def frequencies(lines: list[str], langs: list[str], counts: np.ndarray, heavy: np.ndarray, longest: int) -> pa.Table:
    """``lang, phrase, f`` of the phrases of a shard, given in lines, whose keys have support."""
    chunk = Chunk(lines, langs)
    at = np.flatnonzero(~np.append(False, chunk.joined[:-1])[: len(chunk.words)])
    lengths = np.diff(np.append(at, len(chunk.words)))
    keys = chunk.words[at]
    for step in range(1, longest):
        more = lengths > step
        keys[more] = followed(keys[more], chunk.words[at[more] + step])
    ok = np.isin(keys, heavy)
    at, lengths, keys, counts = at[ok], lengths[ok], keys[ok], counts[ok]

    def texts(rows: np.ndarray) -> pa.Table:
        order, parts = np.argsort(lengths[rows], kind="stable"), []
        cuts = np.searchsorted(lengths[rows][order], np.arange(1, longest + 2))
        for length, (a, b) in enumerate(zip(cuts, cuts[1:]), 1):
            places = at[rows[order[a:b]]]
            names = pa.array(chunk.langs, pa.string()).take(pa.array(chunk.lang[places]))
            parts.append(pa.Table.from_arrays([names, chunk.texts(places, length)], ["lang", "phrase"]))
        return pa.concat_tables(parts).combine_chunks().take(pa.array(np.argsort(order)))

    first = np.unique(keys, return_index=True)[1]
    states = np.zeros(0, np.int32)
    if len(first):
        trie, _ = trie_of(texts(first).to_pandas(), longest)
        states = accepted(trie, chunk, at, lengths)
        if (states < 0).any():  # different phrases have one key
            first = np.append(first, np.flatnonzero(states < 0))
            trie, _ = trie_of(texts(first).to_pandas(), longest)
            states = accepted(trie, chunk, at, lengths)
    _, first, which = np.unique(states, return_index=True, return_inverse=True)
    f = np.zeros(len(first), np.int64)
    np.add.at(f, which, counts)
    return texts(first).append_column("f", pa.array(f))


def counted(texts: DataFrame, bitmaps, heavy: DataFrame, shards: int) -> DataFrame:
    """``lang, phrase, f``: how often phrases with heavy keys occur; without a phrase, words per language."""
    longest = len(bitmaps)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, int] = {}
        held: list[pa.Table] = []
        for chunk in chunks(batches):
            for lang, n in zip(chunk.langs, np.bincount(chunk.lang, minlength=len(chunk.langs))):
                words[lang] = words.get(lang, 0) + int(n)
            held.append(found_in(chunk, [b.value for b in bitmaps]))
            if sum(part.nbytes for part in held) > HELD_BYTES:
                held = [merged(held)]
                if held[0].nbytes > HELD_BYTES // 2:
                    yield dealt(held.pop(), shards)
        if held:
            yield dealt(merged(held), shards)
        if words:
            counts = [np.array([n], np.int64).tobytes() for n in words.values()]
            yield given([-1] * len(words), list(words), pa.nulls(len(words), pa.string()), counts)

    def summed(found: pa.Table, keys: pa.Table) -> pa.Table:
        langs, counts = found["lang"].to_pylist(), b"".join(found["counts"].to_pylist())
        if found.num_rows and found["shard"][0].as_py() < 0:
            words = pa.table({"lang": found["lang"], "f": np.frombuffer(counts, np.int64)})
            words = words.group_by("lang").aggregate([("f", "sum")])
            return pa.table({"lang": words["lang"], "phrase": pa.nulls(len(words), pa.string()), "f": words["f_sum"]})
        n = np.frombuffer(counts, np.uint32).astype(np.int64)
        heavy = keys["key"].to_numpy().view(np.uint64)
        return frequencies(found["phrases"].to_pylist(), langs, n, heavy, longest)

    keys = heavy.select(F.pmod("key", F.lit(shards)).cast("int").alias("shard"), "key")
    found = texts.mapInArrow(task, GIVEN).groupBy("shard")
    return found.cogroup(keys.groupBy("shard")).applyInArrow(summed, "lang string, phrase string, f long")


def count_phrases(
    docs: DataFrame, steps: Steps, least: int = LEAST, longest: int = LONGEST
) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, f`` of every phrase of up to ``longest`` words that occurs ``least``
    times or more, and ``lang, n``, the words of each language.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    bitmaps, heavy = [], []
    for length in range(1, longest + 1):
        heavy.append(steps.store(f"heavy{length}", support(texts, length, list(bitmaps), least)))
        bitmaps.append(spark.sparkContext.broadcast(bitmap(heavy[-1], BITMAP_BITS)))
    every = heavy[0]
    for keys in heavy[1:]:
        every = every.unionByName(keys)
    shards = max(2 * partitions_for(spark), -(-every.count() // SHARD))
    counts = steps.store("counts", counted(texts, bitmaps, every, shards))
    steps.drop(*[f"heavy{i}" for i in range(1, longest + 1)])
    frequent = counts.filter(F.col("phrase").isNotNull() & (F.col("f") >= least))
    return frequent, counts.filter(F.col("phrase").isNull()).select("lang", F.col("f").alias("n"))


def mine(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """The best phrases of each language.

    Per language the first ``top`` candidates by score, count and phrase: ``lang, rank,
    phrase, a, l, r, n, score``. A candidate's score is that of its lowest-scoring cut into a
    first part and a rest. Candidates within longer ones of half their count are left out.
    """
    steps = Steps(docs.sparkSession)
    frequent, totals = count_phrases(docs, steps, least, longest)
    words = F.split("phrase", " ")
    candidates = frequent.withColumn("words", words).filter(F.size("words") > 1)

    def part(start, size):
        return F.array_join(F.slice("words", start, size), " ")

    cut = F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k")
    cuts = candidates.select("lang", "phrase", F.col("f").alias("a"), "words", cut).select(
        "lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("head"), part(F.col("k") + 1, F.size("words")).alias("rest")
    )

    def counts(name: str, count: str) -> DataFrame:
        return frequent.select("lang", F.col("phrase").alias(name), F.col("f").alias(count))

    # both sides read a table, so a part that many phrases share can be split
    cuts = cuts.join(counts("head", "l"), ["lang", "head"]).join(counts("rest", "r"), ["lang", "rest"])

    def whole(name: str):
        return F.col(name).cast("decimal(16,0)")

    scaled = whole("a") * whole("a") * F.lit(1_000_000).cast("decimal(7,0)")
    score = F.call_function("div", scaled, whole("l") * whole("r")).alias("score")
    scored = (
        cuts.select("lang", "phrase", "a", "k", "l", "r", score)
        .groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    )
    size = F.size("words")
    inner = F.explode(
        F.flatten(
            F.transform(
                F.sequence(F.lit(2), size - 1),
                lambda n: F.transform(F.sequence(F.lit(1), size - n + 1), lambda i: F.array_join(F.slice("words", i, n), " ")),
            )
        )
    ).alias("phrase")
    longer = (
        candidates.filter(size > 2)
        .select("lang", "f", inner)
        .groupBy("lang", "phrase")
        .agg(F.max("f").alias("longer"))
    )
    kept = scored.join(longer, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (100 * F.col("longer") < 50 * F.col("a"))
    )

    def first(df: DataFrame, *by: str) -> DataFrame:
        best = Window.partitionBy(*by).orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
        return df.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)

    # the first of each part of a language, then of these: no task gets a whole language
    parts = 4 * math.isqrt(partitions_for(docs.sparkSession))
    dealt_out = kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(parts)))
    ranked = first(first(dealt_out, "lang", "part"), "lang")
    return ranked.join(totals, "lang").select(
        "lang",
        F.col("rank").cast("long").alias("rank"),
        "phrase",
        "a",
        F.col("cut.l").alias("l"),
        F.col("cut.r").alias("r"),
        "n",
        F.col("cut.score").cast("long").alias("score"),
    )
