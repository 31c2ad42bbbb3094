"""SentencePiece encoding with the N best segmentations, and decoding.

The lattice of a text has a node per gap between code points and an edge per vocabulary
piece. Forward Viterbi gives every node the score of the best way to reach it. Used as the
heuristic of a backward A* search it is exact, so the search pops complete segmentations in
order of their score, and the N best are the first N.

A lattice falls apart where no piece crosses: before a run of spaces that follows something
else, and around line ends and tabs. Viterbi runs over all distinct parts of a block of texts
at once, in arrays, and also gives what the second choice of a part costs. A segmentation of
rank N can only differ from the best in the N - 1 parts whose second choice costs least, so
the A* search runs for those parts of each text, and their lists are merged.

Scores are those of the vocabulary file, summed. Spaces become U+2581 and one is put in
front, as the vocabulary expects; a code point without a piece of its own is spelt in byte
pieces, and so is a U+2581 of the text, which makes ``decode`` give back every text exactly.
Of equal scores the best is that with the longer last pieces; the others come in the order
of the search.

Defined cases: a null or empty text has no pieces, score 0 and one segmentation; null ids
decode to an empty text; repeated rows are encoded alike; long texts are encoded whole; an
empty table gives no rows. Only id and text are read.
"""

import heapq
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

SPACE = "▁"
#: Stands for a U+2581 of the text itself while it is segmented; no valid text holds it.
OWN = "\ud800"
N_BEST = 4
#: Characters of texts whose parts are segmented together, and the longest part done so.
BLOCK_CHARS = 4_000_000
ARRAY_LENGTH = 48
#: Parts whose search results a task keeps at once.
KEPT_PARTS = 50_000
FACTOR = np.uint64(0x9E3779B97F4A7C15)


def vocabulary() -> str:
    """Default vocabulary file; it must be readable on every executor."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """A vocabulary and its segmentations."""

    def __init__(self, path: str, n_best: int = N_BEST):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.n_best = n_best
        self.names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.bytes, self.scores = {}, {}
        for number, name in enumerate(self.names):
            if model.is_byte(number):
                self.bytes[int(name[3:5], 16)] = (number, model.get_score(number))
            elif not (
                model.is_control(number) or model.is_unknown(number) or model.is_unused(number)
            ):
                self.scores[name] = (number, model.get_score(number))
        self.spelt = [name.replace(SPACE, " ").encode("utf-8") for name in self.names]
        for byte, (number, _) in self.bytes.items():
            self.spelt[number] = bytes([byte])
        self.longest = max(map(len, self.scores), default=1)
        inside = {c for name in self.scores if len(name) > 1 for c in name}
        apart = "".join(c for c in "\n\r\t" if c not in inside)
        if any(SPACE in name.lstrip(SPACE) for name in self.scores):
            raise ValueError(f"{path}: a piece crosses the start of a word")
        part = rf"{SPACE}+[^{SPACE}{apart}]*|[^{SPACE}{apart}]+"
        self.split = re.compile(f"[{apart}]|{part}" if apart else part).findall
        self.kept: dict[str, list] = {}
        names = list(self.scores)
        keys = np.array([self._key(name) for name in names], np.uint64)
        order = np.argsort(keys)
        self.keys = keys[order]
        if (np.diff(self.keys) == 0).any():
            raise ValueError(f"{path}: two pieces have one key")
        self.numbers = np.array([self.scores[n][0] for n in names], np.int32)[order]
        self.values = np.array([self.scores[n][1] for n in names])[order]
        # The first key by its top bits, and where several share them.
        top = (self.keys >> np.uint64(44)).astype(np.int64)
        self.slots = np.full(1 << 20, -1, np.int32)
        self.slots[top[::-1]] = np.arange(len(top), dtype=np.int32)[::-1]
        self.crowded = np.bincount(top, minlength=1 << 20) > 1

    @staticmethod
    def _key(name: str) -> int:
        key = 0
        for char in name:
            key = ((key + ord(char) + 1) * int(FACTOR)) % (1 << 64)
        return key

    def spell(self, char: str) -> tuple[list[int], float]:
        """A code point in byte pieces."""
        char = SPACE if char == OWN else char
        found = [self.bytes[b] for b in char.encode("utf-8", "replace")]
        return [number for number, _ in found], sum(score for _, score in found)

    def search(self, part: str) -> list[tuple[float, tuple[int, ...]]]:
        """The N best segmentations of a part, the best first, with their scores."""
        scores, longest, size = self.scores, self.longest, len(part)
        best = [0.0] * (size + 1)
        into: list[list] = [[] for _ in range(size + 1)]  # edges by their end
        for end in range(1, size + 1):
            edges = into[end]
            top = None
            for start in range(max(0, end - longest), end):
                found = scores.get(part[start:end])
                if found is not None:
                    number, score = found
                    edges.append((start, number, score))
                    total = best[start] + score
                    if top is None or total > top:
                        top = total
            if part[end - 1] not in scores:
                numbers, score = self.spell(part[end - 1])
                edges.append((end - 1, tuple(numbers), score))
                total = best[end - 1] + score
                if top is None or total > top:
                    top = total
            best[end] = top
        results: list = []
        order = 0
        heap = [(-best[size], 0, size, 0.0, None)]
        while heap and len(results) < self.n_best:
            cost, _, node, done, path = heapq.heappop(heap)
            if node == 0:
                ids: list[int] = []
                while path is not None:
                    number, path = path
                    if type(number) is tuple:
                        ids.extend(number)
                    else:
                        ids.append(number)
                results.append((-cost, tuple(ids)))
                continue
            for start, number, score in into[node]:
                order += 1
                tail = done + score
                heapq.heappush(heap, (-tail - best[start], order, start, tail, (number, path)))
        return results

    def _edges(self, codes: np.ndarray):
        """For each piece length: which substrings are pieces, as indexes into the keys or -1."""
        key = np.zeros(codes.shape, np.uint64)
        for length in range(1, min(self.longest, codes.shape[1]) + 1):
            starts = codes.shape[1] - length + 1
            key = (key[:, :starts] + codes[:, length - 1 :] + np.uint64(1)) * FACTOR
            top = (key >> np.uint64(44)).astype(np.int64)
            found = self.slots[top]
            likely = np.nonzero(found >= 0)
            wanted, at = key[likely], found[likely]
            hit = self.keys[at] == wanted
            missed = np.nonzero(~hit & self.crowded[top[likely]])[0]
            at[missed] = np.minimum(np.searchsorted(self.keys, wanted[missed]), len(self.keys) - 1)
            found[likely] = np.where(self.keys[at] == wanted, at, -1)
            yield length, found

    def best(self, parts: list[str]):
        """Viterbi for parts of equal length, whose code points all have pieces of their own.

        Returns score, loss of the second choice, and three arrays that list the pieces:
        part, place from the end, id. A fourth tells which parts have no such code points
        and were left out.
        """
        size = len(parts[0])
        codes = np.array(parts, f"<U{size}").view(np.uint32).reshape(-1, size).astype(np.uint64)
        edges = dict(self._edges(codes))
        odd = (edges[1] < 0).any(axis=1)
        n = len(parts)
        first, second = np.full((size + 1, n), -np.inf), np.full((size + 1, n), -np.inf)
        first[0] = 0
        back, piece = np.zeros((size + 1, n), np.int16), np.zeros((size + 1, n), np.int32)
        for end in range(1, size + 1):
            top, next_top = first[end], second[end]
            for length in range(min(end, self.longest), 0, -1):
                found = edges[length][:, end - length]
                at = np.nonzero(found >= 0)[0]
                if not len(at):
                    continue
                score = self.values[found[at]]
                one, two = first[end - length, at] + score, second[end - length, at] + score
                old = top[at]
                next_top[at] = np.maximum(np.maximum(next_top[at], two), np.minimum(old, one))
                top[at] = np.maximum(old, one)
                won = at[one > old]
                back[end, won] = length
                piece[end, won] = found[won]
        node = np.where(odd, 0, size)
        listed = []
        while len(part := np.nonzero(node > 0)[0]):
            ends = node[part]
            listed.append((part, np.full(len(part), -len(listed)), self.numbers[piece[ends, part]]))
            node[part] = ends - back[ends, part]
        columns = [np.concatenate(c) for c in zip(*listed)] if listed else [np.zeros(0, int)] * 3
        with np.errstate(invalid="ignore"):
            loss = first[size] - second[size]
        return first[size], loss, columns, odd

    def choices(self, part: str, best: tuple[float, tuple[int, ...]]):
        """The segmentations of a part, the given best one first."""
        found = self.kept.get(part)
        if found is None:
            if len(self.kept) >= KEPT_PARTS:
                self.kept.clear()
            found = self.kept[part] = self.search(part)
        rest = [one for one in found if one != best]
        return [best, *rest[: self.n_best - 1]]

    def encode_all(self, texts: list[str | None]) -> list[tuple]:
        """Per text: ids of the best segmentation, its score, and the others.

        Another one is its score and its changes: (index into the best ids, how many of them
        go, ids that come instead).
        """
        split = [self.parts(text) if text else [] for text in texts]
        if any(SPACE in text for text in texts if text):  # pandas does not tell surrogates apart
            order: dict[str, int] = {}
            found = [order.setdefault(part, len(order)) for part in chain.from_iterable(split)]
            numbers, names = np.array(found), list(order)
        else:
            every = np.array([*chain.from_iterable(split), None], object)[:-1]
            numbers, distinct = pd.factorize(every)
            names = distinct.tolist()
        score, loss = np.zeros(len(names)), np.full(len(names), np.inf)
        by_length: dict[int, list[int]] = defaultdict(list)
        for i, name in enumerate(names):
            by_length[min(len(name), ARRAY_LENGTH + 1)].append(i)
        slow = by_length.pop(ARRAY_LENGTH + 1, [])
        listed = []
        for members in by_length.values():
            group = np.array(members)
            score[group], loss[group], (part, place, ids), odd = self.best([names[i] for i in members])
            listed.append((group[part], place, ids))
            slow += group[odd].tolist()
        for i in slow:
            found = self.search(names[i])
            score[i], ids = found[0]
            loss[i] = found[0][0] - found[1][0] if len(found) > 1 else np.inf
            listed.append((np.full(len(ids), i), np.arange(len(ids)), np.array(ids)))
        part, place, ids = (np.concatenate(c) for c in zip(*listed)) if listed else [np.zeros(0, int)] * 3
        ids = ids[np.lexsort((place, part))].astype(np.int32)
        count = np.bincount(part, minlength=len(names))
        begin = np.cumsum(count) - count
        out = []
        done = 0
        for parts in split:
            at = numbers[done : done + len(parts)]
            done += len(parts)
            sizes = count[at]
            ends = np.cumsum(sizes)
            starts = ends - sizes
            shift = np.repeat(begin[at] - starts, sizes)
            own = ids[shift + np.arange(len(shift))]
            total = float(score[at].sum())
            out.append((own, total, self._others(parts, own, starts, sizes, score[at], loss[at], total)))
        return out

    def encode(self, text: str | None) -> tuple:
        return self.encode_all([text])[0]

    def _others(self, parts, ids, starts, sizes, scores, losses, total) -> list[tuple]:
        """The other segmentations of a text, from the parts whose second choice costs least."""
        able = np.nonzero(np.isfinite(losses))[0]
        chosen = able[np.argsort(losses[able], kind="stable")[: self.n_best - 1]].tolist()
        ways: list[tuple] = [(0.0, ())]
        lists = {}
        for i in chosen:
            best = (float(scores[i]), tuple(ids[starts[i] : starts[i] + sizes[i]].tolist()))
            lists[i] = self.choices(parts[i], best)
            more = [
                (loss + best[0] - choice[0], used + ((i, rank),) if rank else used)
                for loss, used in ways
                for rank, choice in enumerate(lists[i])
            ]
            ways = heapq.nsmallest(self.n_best, more)
        return [
            (
                total - loss,
                [(int(starts[i]), int(sizes[i]), list(lists[i][rank][1])) for i, rank in sorted(used)],
            )
            for loss, used in ways[1:]
        ]

    def parts(self, text: str) -> list[str]:
        """Parts of a text, with its own U+2581 marked apart from those that stand for spaces."""
        return self.split(SPACE + text.replace(SPACE, OWN).replace(" ", SPACE))

    def decode(self, ids) -> str:
        return b"".join([self.spelt[i] for i in ids]).decode("utf-8", "replace")[1:]


CHANGES = "array<struct<at:int,gone:int,ids:array<int>>>"


def _blocks(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Rows in blocks of bounded size (a single text may be longer)."""
    chars = batch["text"].map(lambda text: len(text or "")).cumsum()
    for _, block in batch.groupby(chars // BLOCK_CHARS, sort=True):
        yield block


def encode(docs: DataFrame, vocab: str | None = None, n_best: int = N_BEST) -> DataFrame:
    """``doc_id, ids, score, others, exact`` per row, see ``Pieces.encode_all``.

    ``exact`` tells whether the ids decode to the text they came from.
    """
    path = vocab or vocabulary()

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = Pieces(path, n_best)
        for block in (block for batch in batches for block in _blocks(batch)):
            rows = pieces.encode_all(block["text"].tolist())
            others = [
                [
                    {"score": s, "changes": [{"at": a, "gone": g, "ids": i} for a, g, i in changes]}
                    for s, changes in found
                ]
                for _, _, found in rows
            ]
            exact = [pieces.decode(r[0].tolist()) == (t or "") for r, t in zip(rows, block["text"])]
            yield pd.DataFrame(
                {
                    "doc_id": block["doc_id"].array,
                    "ids": [ids for ids, _, _ in rows],
                    "score": [score for _, score, _ in rows],
                    "others": others,
                    "exact": exact,
                }
            )

    schema = (
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>, score double,"
        f" others array<struct<score:double,changes:{CHANGES}>>, exact boolean"
    )
    return docs.select("doc_id", "text").mapInPandas(task, schema)


def apply_changes(ids: Column, changes: Column) -> Column:
    """The ids of another segmentation: the best ids with its changes made."""
    done = F.aggregate(
        changes,
        F.struct(F.slice(ids, 1, 0).alias("out"), F.lit(0).alias("at")),
        lambda state, c: F.struct(
            F.concat(state["out"], F.slice(ids, state["at"] + 1, c["at"] - state["at"]), c["ids"]).alias("out"),
            (c["at"] + c["gone"]).alias("at"),
        ),
    )
    return F.concat(done["out"], F.slice(ids, done["at"] + 1, F.size(ids)))


def decode(ids: Column, vocab: str | None = None) -> Column:
    """Column of texts for a column of ids."""
    path = vocab or vocabulary()

    @F.pandas_udf("string")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        pieces = Pieces(path)
        for batch in batches:
            yield batch.map(lambda ids: pieces.decode(ids.tolist()) if ids is not None else "")

    return texts(ids)
