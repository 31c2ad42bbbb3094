"""Sum-of-squares online packing of tokenised documents into windows of fixed length.

Each task packs the rows of its input partition as they come. Whole windows are cut off a
long document first. What is left of it goes to the fill level that makes the sum of squared
counts of partially filled windows smallest, so no fill level piles up. The state is one
array of counts per level and the windows still open, at most ``MAX_OPEN`` of them: beyond
that, and at the end of the partition, open windows are poured together (documents may be
cut anywhere). The last, partly filled window is cut at powers of two, which need no padding.

No shuffle: packing needs no order between partitions, and a lost task packs its partition
again with the same result.

Defined cases: a null text is empty, so it is the closing id alone; a null id is carried;
repeated rows are packed each on their own; an empty table gives no pieces. Only the id and
the text are read, so other columns cannot clash. Long texts are encoded whole.
"""

import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

CAPACITY = 1024
CLOSING_ID = 0
MAX_OPEN = 4096
#: Fixed value: how byte-level BPE vocabularies of this family split text into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Rows of pieces handed to Spark at once.
OUT_ROWS = 5000


def vocabulary() -> str:
    """Default vocabulary file; it must be readable on every executor."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _printable_bytes() -> dict[str, int]:
    """The characters that byte-level vocabularies write for the 256 bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shifted = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(shifted)}


def load_encoder(path: str):
    """An encoder of texts to ids with the ids of the tokenizer file, a fast one.

    The file's merges stand in the order of their ids, which is what the fast encoder needs;
    that is checked. Its pattern engine refuses some texts (a million spaces): those are
    encoded with the file's own library, as all could be. So are texts that hold the string of
    an added token, which that library reads as the token's id.
    """
    import tiktoken
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    vocab, alphabet = spec["model"]["vocab"], _printable_bytes()
    special = [token["content"] for token in spec["added_tokens"]]
    previous = -1
    for merge in spec["model"]["merges"]:
        left, right = merge.split(" ") if isinstance(merge, str) else merge
        if vocab[left + right] <= previous:
            raise ValueError(f"{path}: merges are not in the order of their ids")
        previous = vocab[left + right]
    ranks = {
        bytes(alphabet[c] for c in piece): rank
        for piece, rank in vocab.items()
        if piece not in special
    }
    encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    slow = Tokenizer.from_file(path)

    def fast(text: str):
        if any(token in text for token in special):
            return None
        try:
            return encoding.encode_to_numpy(text, disallowed_special=())
        except ValueError:
            return None

    def encode(text: str) -> np.ndarray:
        ids = fast(text)
        if ids is None:
            ids = slow.encode(text, add_special_tokens=False).ids
        return np.asarray(ids, "<u4")

    return encode


@dataclass
class Window:
    number: int
    fill: int = 0
    pieces: list = field(default_factory=list)

    def add(self, piece: tuple) -> None:
        self.pieces.append(piece)
        self.fill += len(piece[2])


class SumOfSquares:
    """Open windows by fill level, and where the next piece goes."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.counts = np.zeros(capacity + 1, np.int64)  # open windows per fill level
        self.open: list[list[Window]] = [[] for _ in range(capacity + 1)]
        self.n_open = 0

    def level_for(self, size: int) -> int:
        """The level (0: a new window) whose choice makes the sum of squares smallest.

        Moving a window from level h to h + size changes the sum by 1 - 2 N(h) and
        1 + 2 N(h + size); full windows do not count. Of equal levels the fullest wins.
        """
        low, high = 1, self.capacity - size
        best, change = 0, 2 * int(self.counts[size]) + 1 if size < self.capacity else 0
        if high >= low:
            here = self.counts[low : high + 1]
            after = 2 * self.counts[low + size : high + size + 1] + 1
            after[-1] = 0
            changes = np.where(here > 0, 1 - 2 * here + after, np.iinfo(np.int64).max)
            last = len(changes) - 1 - int(np.argmin(changes[::-1]))
            if changes[last] <= change:
                best = low + last
        return best

    def take(self, level: int) -> Window:
        self.counts[level] -= 1
        self.n_open -= 1
        return self.open[level].pop()

    def put(self, window: Window) -> None:
        self.counts[window.fill] += 1
        self.n_open += 1
        self.open[window.fill].append(window)

    def drain(self) -> list[Window]:
        """All open windows, the fullest first; none stays open."""
        windows = [w for level in reversed(self.open) for w in level]
        self.__init__(self.capacity)
        return windows


def cut(piece: tuple, size: int) -> tuple[tuple, tuple]:
    doc, start, ids, total = piece
    return (doc, start, ids[:size], total), (doc, start + size, ids[size:], total)


def pour(windows: list[Window], capacity: int) -> tuple[list[Window], Window | None]:
    """Fill the fullest windows from the emptiest ones: full windows, and at most one rest."""
    full = []
    first, last = 0, len(windows) - 1
    while first < last:
        target, source = windows[first], windows[last]
        room = capacity - target.fill
        piece = source.pieces.pop()
        source.fill -= len(piece[2])
        if len(piece[2]) > room:
            head, tail = cut(piece, room)
            target.add(head)
            source.add(tail)
        else:
            target.add(piece)
        if target.fill == capacity:
            full.append(target)
            first += 1
        if not source.pieces:
            last -= 1
    return full, windows[first] if first == last and windows[first].pieces else None


def power_cuts(size: int) -> list[int]:
    """The powers of two that make up a length, the largest first."""
    return [1 << b for b in range(size.bit_length() - 1, -1, -1) if size >> b & 1]


def pack_stream(rows, capacity: int, first: int = 0) -> Iterator[Window]:
    """Closed windows for a stream of (id, ids): the packer itself, free of Spark."""
    packer, number = SumOfSquares(capacity), first

    def fresh() -> Window:
        nonlocal number
        number += 1
        return Window(number - 1)

    for doc, ids in rows:
        total, start = len(ids), 0
        while total - start >= capacity:
            window = fresh()
            window.add((doc, start, ids[start : start + capacity], total))
            yield window
            start += capacity
        if start < total:
            level = packer.level_for(total - start)
            window = packer.take(level) if level else fresh()
            window.add((doc, start, ids[start:], total))
            if window.fill == capacity:
                yield window
            else:
                packer.put(window)
        if packer.n_open > MAX_OPEN:
            full, rest = pour(packer.drain(), capacity)
            yield from full
            if rest:
                packer.put(rest)
    full, rest = pour(packer.drain(), capacity)
    yield from full
    pieces = rest.pieces[::-1] if rest else []
    for size in power_cuts(rest.fill) if rest else ():
        window = fresh()
        while window.fill < size:
            piece = pieces.pop()
            if len(piece[2]) > size - window.fill:
                piece, tail = cut(piece, size - window.fill)
                pieces.append(tail)
            window.add(piece)
        yield window


def _rows(window: Window) -> Iterator[tuple]:
    offset = 0
    for doc, start, ids, total in window.pieces:
        yield doc, start, len(ids), zlib.crc32(ids.tobytes()), total, window.number, offset
        offset += len(ids)


COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def pack(docs: DataFrame, vocab: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece of a document: where it stands in the document and in its window.

    ``sequence_id`` is unique over the result: the input partition and a number within it.
    """
    path = vocab or vocabulary()

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = load_encoder(path)
        closing = np.array([CLOSING_ID], "<u4")

        def encoded():
            for batch in batches:
                for doc, text in zip(batch["doc_id"], batch["text"]):
                    yield doc, np.concatenate([encode(text or ""), closing])

        rows: list[tuple] = []
        for window in pack_stream(encoded(), capacity, TaskContext.get().partitionId() << 40):
            rows.extend(_rows(window))
            if len(rows) >= OUT_ROWS:
                yield frame(rows)
                rows = []
        yield frame(rows)

    kind = docs.schema["doc_id"].dataType.simpleString()

    def frame(rows: list[tuple]) -> pd.DataFrame:
        made = pd.DataFrame(rows, columns=COLUMNS).astype({c: "int64" for c in COLUMNS[1:]})
        if kind in ("bigint", "int"):
            made["doc_id"] = made["doc_id"].astype("Int64")
        return made

    schema = f"doc_id {kind}, " + ", ".join(f"{c} long" for c in COLUMNS[1:])
    return docs.select(F.col("doc_id"), F.col("text")).mapInPandas(task, schema)
