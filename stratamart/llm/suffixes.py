"""Suffix-array deduplication: bytes covered by a string of ``THRESHOLD`` bytes that an earlier
document holds too, found by distributed prefix doubling.

Positions are ranked by their first h bytes, h growing from round to round. In a round every
position brings the pair of its rank and the rank at an offset; Spark deals the pairs out by
ranges of their order, each task sorts its range and reranks it: equal pairs share a class, of
which the smallest document is known. A position whose class lies in one document drops out;
the others go on to the next offset, until the threshold is passed. A rank here is a 64-bit
name of the bytes it stands for (the first one the eight bytes themselves), so a task that
holds the text has the rank at any offset at hand, and only the sorting is a shuffle.

Two things keep the first rounds small. Windows of the threshold's length start out not each
for itself but in runs: the least name among the 24-byte strings of a window stands for all
neighbouring windows with that least name, and equal windows have equal ones. And in the
second round a run stands as a whole: if its whole context is found in an earlier document,
all of it is repeated, so copies of a passage go on only once. Rounds:

1. 24 bytes, those with the least name of each run;
2. the whole context of their runs (first 32 bytes, the 32 that end the first window, the
   last 32);
3. 32 bytes, of each window in runs that share a 24-byte string but not their context;
4. 50 bytes, as the pair of names at offsets 0 and 18: past the threshold.

Documents are laid out once in parts (a bucketed table in the shared folder), so no round
moves texts again. What a part sends of a class is one entry, so a passage in a third of all
documents costs a bucket one entry per part. A part's bytes are bounded, as are buckets by
the session's number of shuffle partitions. Answers are written out after each round.

Defined cases: a null or empty text has no bytes; ids must be integers; a null id neither
removes nor is removed; rows with the same id do not remove each other, repeated rows get
equal results; an empty table gives no rows. Long documents are taken whole (a part holds at
least one). Only id and text are read.
"""

import uuid
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from stratamart.llm.common import partitions_for
from stratamart.llm.graphs import stored
from stratamart.sources.layers import scratch_directory

THRESHOLD = 50
GRAM = 24
NAME = 32
PART_BYTES = 2_500_000
STRETCH = 1 << 15
GOLDEN, SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
NO_DOC = np.iinfo(np.int64).max


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * SPREAD
    return x ^ (x >> np.uint64(32))


class Part:
    """The texts of some documents one after another, and the names of their positions."""

    def __init__(self, ids: np.ndarray, texts: list[bytes], threshold: int = THRESHOLD):
        self.ids, self.threshold = ids, threshold
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.ends = np.cumsum(self.sizes)
        padded = b"".join([*texts, bytes(NAME + 8)])
        self.size = len(padded) - NAME - 8
        self.bytes = np.frombuffer(padded, np.uint8, self.size)
        # Eight bytes from every position, as a big-endian number: the first rank.
        self.eight = np.ndarray((len(padded) - 7,), ">u8", padded, strides=(1,))

    def name(self, at: np.ndarray) -> np.ndarray:
        """Names of the first ``NAME`` bytes of positions."""
        name = _mix(self.eight[at].astype(np.uint64) * GOLDEN)
        for k in range(8, NAME, 8):
            name = _mix((name + self.eight[at + k].astype(np.uint64)) * GOLDEN)
        return name

    def _grams(self, start: int, stop: int) -> np.ndarray:
        """Names of the first ``GRAM`` bytes of all positions of a range."""
        name = self.eight[start:stop].astype(np.uint64)
        name *= GOLDEN
        for k in range(8, GRAM, 8):
            name ^= name >> np.uint64(29)
            name += self.eight[start + k : stop + k]
            name *= SPREAD
        name ^= name >> np.uint64(32)
        return name

    def _least(self) -> np.ndarray:
        """The least name of each window, computed in stretches that fit a processor's cache."""
        slide = self.threshold - GRAM + 1
        windows = self.size - self.threshold + 1
        out = np.empty(max(0, windows), np.uint64)
        for start in range(0, windows, STRETCH):
            stop = min(windows, start + STRETCH)
            least, span = self._grams(start, stop + slide - 1), 1
            while span < slide:
                step = min(span, slide - span)
                least = np.minimum(least[:-step], least[step:])
                span += step
            out[start:stop] = least
        return out

    def runs(self):
        """Runs of windows with one least name: first window, one past the last, the name, the
        document's index. A run is cut where its context would be longer than is named."""
        least = self._least()
        inside = np.ones(len(least), bool)
        for k in range(1, self.threshold):
            at = (self.ends - k)[self.sizes >= k]
            inside[at[at < len(least)]] = False
        new = inside.copy()
        new[1:] &= (least[1:] != least[:-1]) | ~inside[:-1]
        first = np.nonzero(new)[0]
        last = inside.copy()
        last[:-1] &= (least[1:] != least[:-1]) | ~inside[1:]
        past = np.nonzero(last)[0] + 1
        longest = 2 * NAME + (self.threshold - NAME) - self.threshold + 1
        pieces = (past - first + longest - 1) // longest
        if (pieces > 1).any():
            nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            first = np.repeat(first, pieces) + nth * longest
            past = np.minimum(np.repeat(past, pieces), first + longest)
        # Least names crowd at the low end of their range: mixed again, they fill it evenly.
        name = _mix(least[first] * GOLDEN)
        return first, past, name, np.searchsorted(self.ends, first, "right")


class Entries:
    """Distinct pairs of ranks in a part, in their order, each with its smallest document.

    Positions come in the order of their documents, so the first of a class has the smallest.
    """

    def __init__(self, high: np.ndarray, low: np.ndarray | None, docs: np.ndarray):
        self.order = np.argsort(high, kind="stable") if low is None else np.lexsort((low, high))
        high, docs = high[self.order], docs[self.order]
        low = None if low is None else low[self.order]
        new = np.ones(len(high), bool)
        new[1:] = np.diff(high) != 0
        if low is not None:
            new[1:] |= np.diff(low) != 0
        at = np.nonzero(new)[0]
        self.new, self.high, self.least = new, high[at], docs[at]
        self.low = None if low is None else low[at]
        self.several = (np.maximum.reduceat(docs, at) != docs[at]) if len(at) else np.zeros(0, bool)
        self.entry = np.cumsum(new) - 1

    def back(self, answers: np.ndarray) -> np.ndarray:
        """Answers to the entries, for the positions the entries came from."""
        out = np.empty(len(self.order), answers.dtype)
        out[self.order] = answers[self.entry]
        return out

    def rows(self, part: int, buckets: int) -> list[tuple]:
        """Entries by range of rank, as bytes: what the part sends."""
        bucket = ((self.high >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        cuts = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
        rows = []
        for b in range(buckets):
            s = slice(cuts[b], cuts[b + 1])
            if s.start < s.stop:
                pair = (b"", b"") if self.low is None else (self.low[s].tobytes(), self.least[s].tobytes())
                rows.append((part, b, self.high[s].tobytes(), *pair, np.packbits(self.several[s]).tobytes()))
        return rows


SENT = "part long, bucket long, high binary, low binary, least binary, several binary"
ANSWER = "part long, bucket long, round int, n long, flags binary, least binary"


def rerank(round_: int, paired: bool) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """The sort of one range of ranks: an answer to each entry of each part.

    The flag tells that the class (rounds of single ranks) or the rank's first half (rounds of
    pairs) does not stand alone; ``least`` is the smallest document of the class.
    """

    def task(rows: pd.DataFrame) -> pd.DataFrame:
        if rows["bucket"].iloc[0] < 0:  # what a part keeps for itself
            return pd.DataFrame(
                {
                    "part": rows["part"],
                    "bucket": rows["bucket"],
                    "round": 0,
                    "n": 0,
                    "flags": rows["several"],
                    "least": rows["high"],
                }
            )
        high = [np.frombuffer(x, np.uint64) for x in rows["high"]]
        sizes = [len(x) for x in high]
        high = np.concatenate(high)
        if paired:
            low = np.concatenate([np.frombuffer(x, np.uint64) for x in rows["low"]])
            least = np.concatenate([np.frombuffer(x, np.int64) for x in rows["least"]])
        else:
            low, least = np.zeros(len(high), np.uint64), np.zeros(0, np.int64)
        several = np.concatenate(
            [np.unpackbits(np.frombuffer(x, np.uint8), count=n) for x, n in zip(rows["several"], sizes)]
        ).astype(bool)
        order = np.lexsort((low, high))
        new_high = np.ones(len(order), bool)
        new_high[1:] = np.diff(high[order]) != 0
        new = new_high.copy()
        new[1:] |= np.diff(low[order]) != 0
        at = np.nonzero(new)[0]
        group = np.cumsum(new) - 1
        first = np.zeros(0, np.int64)
        if paired:
            starts = np.nonzero(new_high)[0]
            classes = np.add.reduceat(new.astype(np.int64), starts)
            flag = (classes > 1)[np.cumsum(new_high) - 1]
            first = np.empty(len(order), np.int64)
            first[order] = np.minimum.reduceat(least[order], at)[group]
        else:
            count = np.diff(np.append(at, len(order)))
            flag = (count > 1)[group] | np.logical_or.reduceat(several[order], at)[group]
        flags = np.empty(len(order), bool)
        flags[order] = flag
        cuts = np.cumsum([0, *sizes])
        return pd.DataFrame(
            {
                "part": rows["part"].to_numpy(),
                "bucket": rows["bucket"].to_numpy(),
                "round": round_,
                "n": sizes,
                "flags": [np.packbits(flags[a:b]).tobytes() for a, b in zip(cuts, cuts[1:])],
                "least": [first[a:b].tobytes() if paired else b"" for a, b in zip(cuts, cuts[1:])],
            }
        )

    return task


class Positions:
    """Where a part stands after the rounds answered so far."""

    def __init__(self, docs: pd.DataFrame, answers: pd.DataFrame, threshold: int = THRESHOLD):
        docs = docs.sort_values(["doc_id", "text"], na_position="first")
        self.docs, self.answers = docs, answers
        self.texts = [(t or "").encode("utf-8", "replace") for t in self.docs["text"]]
        self.part = Part(self.docs["doc_id"].to_numpy(np.int64), self.texts, threshold)

    def _answers(self, round_: int):
        rows = self.answers[self.answers["round"] == round_].sort_values("bucket")
        flags = [
            np.unpackbits(np.frombuffer(x, np.uint8), count=n) for x, n in zip(rows["flags"], rows["n"])
        ]
        least = [np.frombuffer(x, np.int64) for x in rows["least"]]
        return (
            np.concatenate([np.zeros(0, np.uint8), *flags]).astype(bool),
            np.concatenate([np.zeros(0, np.int64), *least]),
        )

    def first_round(self) -> Entries:
        _, _, name, doc = self.runs = self.part.runs()
        return Entries(name, None, self.part.ids[doc])

    def second_round(self) -> tuple[Entries, tuple[bytes, bytes]]:
        """Runs that are left, and what later rounds need of them: their places in the order
        of the entries, and where a new entry begins."""
        part = self.part
        alive = self.first_round().back(self._answers(1)[0])
        first, past, name, doc = (x[alive] for x in self.runs)
        context = part.name(first)
        for more in (first + part.threshold - NAME, past - 1 + part.threshold - NAME):
            context = _mix((context + part.name(more)) * GOLDEN)
        context = _mix(context + (past - first).astype(np.uint64) * GOLDEN)
        entries = Entries(name, context, part.ids[doc])
        first, sizes = first[entries.order], (past - first)[entries.order]
        places = first.astype(np.int32).tobytes() + sizes.astype(np.uint8).tobytes()
        return entries, (places, np.packbits(entries.new).tobytes())

    def third_round(self) -> Entries:
        """Windows of runs whose context is not found earlier, but parts of it elsewhere."""
        part, kept = self.part, self.answers[self.answers["round"] == 0]
        places = kept["least"].iloc[0] if len(kept) else b""
        n = len(places) // 5
        first = np.frombuffer(places, np.int32, n).astype(np.int64)
        sizes = np.frombuffer(places, np.uint8, n, 4 * n).astype(np.int64)
        new = np.unpackbits(np.frombuffer(kept["flags"].iloc[0], np.uint8), count=n) if n else first
        entry = np.cumsum(new.astype(np.int64)) - 1
        mixed, least = (x[entry] for x in self._answers(2))
        ids = part.ids[np.searchsorted(part.ends, first, "right")]
        whole = least < ids
        end = first + sizes - 1 + part.threshold
        self.stretches = [(first[whole], end[whole])]
        left = np.nonzero(mixed & ~whole)[0]
        left = left[np.argsort(first[left])]
        first, sizes, ids = first[left], sizes[left], ids[left]
        self.windows = np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        self.owners = np.repeat(ids, sizes)
        self.names = part.name(self.windows)
        return Entries(self.names, None, self.owners)

    def fourth_round(self) -> Entries:
        alive = self.third_round().back(self._answers(3)[0])
        self.windows, self.owners = self.windows[alive], self.owners[alive]
        last = self.part.name(self.windows + self.part.threshold - NAME)
        return Entries(self.names[alive], last, self.owners)

    def repeated(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Starts and ends of stretches of repeated bytes."""
        least = self.fourth_round().back(self._answers(4)[1])
        found = self.windows[least < self.owners]
        return [*self.stretches, (found, found + self.part.threshold)]

    def send(self, round_: int, part: int, buckets: int) -> pd.DataFrame:
        """The entries of a round, and in the second what the part keeps for itself."""
        if round_ == 2:
            entries, (places, new) = self.second_round()
            rows = [*entries.rows(part, buckets), (part, -1 - part % buckets, places, b"", b"", new)]
        else:
            steps = {1: self.first_round, 3: self.third_round, 4: self.fourth_round}
            rows = steps[round_]().rows(part, buckets)
        return pd.DataFrame(rows, columns=["part", "bucket", "high", "low", "least", "several"])


PAIRED = {1: False, 2: True, 3: False, 4: True}
REMOVED = "doc_id long, digest long, n_bytes long, n_removed long, n_spans long, kept binary"


def _removed(docs: pd.DataFrame, answers: pd.DataFrame, threshold: int) -> pd.DataFrame:
    """The result for the documents of a part."""
    positions = Positions(docs, answers, threshold)
    part = positions.part
    edge = np.zeros(len(part.bytes) + 1, np.int32)
    for start, end in positions.repeated():
        np.add.at(edge, start, 1)
        np.add.at(edge, end, -1)
    gone = np.cumsum(edge[:-1]) > 0
    rows = []
    digests = positions.docs["digest"]
    for doc, digest, text, end, size in zip(part.ids, digests, positions.texts, part.ends, part.sizes):
        own = gone[end - size : end]
        n_removed = int(own.sum())
        spans = int(own[:1].sum() + (np.diff(own.astype(np.int8)) == 1).sum())
        kept = text if not n_removed else part.bytes[end - size : end][~own].tobytes()
        rows.append((doc, digest, size, n_removed, spans, kept))
    names = ["doc_id", "digest", "n_bytes", "n_removed", "n_spans", "kept"]
    return pd.DataFrame(rows, columns=names)


def _laid_out(docs: DataFrame) -> DataFrame:
    """The documents in parts of bounded size, stored bucketed by part.

    The catalog's entry is only needed to open the table; the files stay in the shared folder.
    """
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = total // PART_BYTES + 1
    rows = docs.select(
        F.pmod(F.xxhash64("doc_id"), F.lit(parts)).alias("part"), *docs.columns
    )
    name = f"parts_{uuid.uuid4().hex}"
    buckets = partitions_for(spark)
    (
        rows.repartition(buckets, "part")
        .write.bucketBy(buckets, "part")
        .option("path", scratch_directory(spark))
        .saveAsTable(name)
    )
    laid = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return laid


def remove_repeats(
    docs: DataFrame, threshold: int = THRESHOLD, once: bool = False, as_text: bool = False
) -> DataFrame:
    """Per row: id, digest of the text, lengths, number of spans, and the remaining bytes.

    With ``once``, rows of one id and one text give one row. With ``as_text``, what remains is a
    string; a code point goes as soon as a byte does.
    """
    spark = docs.sparkSession
    digest = F.xxhash64("text").alias("digest")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest, "text")
    laid = _laid_out(rows.filter(F.col("doc_id").isNotNull()))
    buckets = 2 * partitions_for(spark)
    # Not createDataFrame: its rows come from Python workers of their own, even if there are none.
    columns = [column.split() for column in ANSWER.split(", ")]
    answers = spark.range(0).select(*(F.lit(None).cast(kind).alias(name) for name, kind in columns))

    def by_part(function, schema):
        grouped = laid.groupBy("part").cogroup(answers.groupBy("part"))
        return grouped.applyInPandas(function, schema)

    def sender(round_):
        def task(key, rows: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
            return Positions(rows, known, threshold).send(round_, int(key[0]), buckets)

        return task

    for round_, paired in PAIRED.items():
        sent = by_part(sender(round_), SENT)
        ranked = sent.groupBy("bucket").applyInPandas(rerank(round_, paired), ANSWER)
        answers = answers.unionByName(stored(ranked))

    def finish(key, rows: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        made = _removed(rows, known, threshold)
        if as_text:
            made["kept"] = [kept.decode("utf-8", "ignore") for kept in made["kept"]]
        # All rows of one id are in one part, a null id's are not laid out.
        return made.drop_duplicates(["doc_id", "digest"]) if once else made

    schema = REMOVED.replace("kept binary", "kept string") if as_text else REMOVED
    return by_part(finish, schema).unionByName(_unnamed(rows, once, as_text))


def _unnamed(rows: DataFrame, once: bool, as_text: bool) -> DataFrame:
    """Rows without an id take no part: however many they are, they are not brought together."""
    text = F.coalesce("text", F.lit("")).cast("string" if as_text else "binary")
    none = F.lit(0).cast("long")
    kept = rows.filter(F.col("doc_id").isNull()).select(
        "doc_id",
        "digest",
        F.octet_length(text).cast("long").alias("n_bytes"),
        none.alias("n_removed"),
        none.alias("n_spans"),
        text.alias("kept"),
    )
    return kept.dropDuplicates(["digest"]) if once else kept


def deduplicate(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """The documents with what remains as their text; a code point goes as soon as a byte does.

    Null texts stay null. The parts give strings: a Python function of the joined rows would run
    once for the text and once for each filter on it, with a further worker for each.
    """
    removed = remove_repeats(docs, threshold, once=True, as_text=True)
    removed = removed.select(F.struct("doc_id", "digest", "kept").alias("r"))
    rows = docs.select(F.struct("*").alias("row"), F.xxhash64("text").alias("key"))
    same = F.col("row.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("key") == F.col("r.digest"))
    text = F.when(F.col("row.text").isNotNull(), F.col("r.kept"))
    columns = [
        text.alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns
    ]
    return rows.join(removed, same).select(*columns)
