"""Deduplication of runs of lines by winnowing, in DataFrame functions only.

A document is the sequence of its lines that hold a word.

*Fingerprints.* Of every window of ``RUN`` consecutive line hashes the smallest is selected
(the last of equal ones), so two equal runs of at least ``RUN`` lines are sure to share one.
With ``short_words``, a run of fewer lines that holds so many words is a window of its own,
and so is the whole of a document of fewer than ``RUN`` lines, among such documents. A shorter
passage on fewer lines stays.

*Positions.* Only selected lines are given as rows, each with the lines around it. A
fingerprint that stands at a single place in all documents ends there: places are counted by
an aggregate and joined back.

*Extension.* From each place that is left the match is extended up and down, to the windows
in which its line was selected. What is equal to an earlier place over a whole window is
found by the first place of every window's key, an aggregate again; so a passage in very many
documents is compared with its first place and no pair of copies is ever built. Windows with
an earlier place that overlap or touch make up the repeated run, and all its lines are
deleted. The first place keeps them.

Earlier means a smaller id, or further up in the same document (also where the two overlap).
Lines are compared whole; lines without a word are neither compared nor deleted, and do not
interrupt a run. Both joins back are lookups that adaptive execution can split where a passage
is very frequent.

Defined cases: a null text stays null, an empty one empty; a null id comes before all others;
rows that share id and text are one document and keep the same lines; an empty table gives no
rows. Other columns are passed through by ``deduplicate`` and cannot clash: the working
columns are made from id and text alone.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from stratamart.llm.common import WORD, let
from stratamart.operators.joins import inner_lookup

RUN = 3
#: Words from which the query and the pipeline compare a run of fewer than ``RUN`` lines.
SHORT_WORDS = 50
HAS_WORD = r"[^\x20\x09-\x0D]"
#: What else than a blank stands between words of a line.
OTHER_SPACES = ("\t", "\x0b", "\x0c", "\r")


def _split(text):
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _worded(lines):
    """Indexes (from 0) of the lines that hold a word."""
    marked = F.transform(lines, lambda line, i: F.when(line.rlike(HAS_WORD), i))
    return F.filter(marked, lambda i: i.isNotNull())


def _last_least(hashes: Column, first: Column, size: int) -> Column:
    """Where in a window the smallest hash stands, the last of equal ones (from 0)."""
    at = [F.get(hashes, first + k) for k in range(size)]
    least = F.least(*at) if size > 1 else at[0]
    place = first
    for k in range(1, size):
        place = F.when(at[k] == least, first + k).otherwise(place)
    return place


def _words(line: Column) -> Column:
    """Words of a line: where blanks stand one by one between words, as many and one more."""
    blanks = F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit("")))
    odd = line.startswith(" ") | line.endswith(" ")
    odd = reduce(Column.__or__, [F.contains(line, F.lit(c)) for c in ("  ", *OTHER_SPACES)], odd)
    return F.when(odd, F.regexp_count(line, F.lit(WORD))).otherwise(blanks + 1)


def fingerprints(
    docs: DataFrame, run: int = RUN, short_words: int | None = None, around: bool = True
) -> DataFrame:
    """One row per selected line: ``mark`` (its hash), ``doc``, ``place`` (from 0).

    With ``around``, also the hashes ``near`` it, the place ``begin`` of the first of them, the
    ``size`` of the windows that selected it, and ``whole`` if that is all of a document.
    """
    lines = F.filter(_split(F.col("text")), lambda line: line.rlike(HAS_WORD))

    def row(hashes, place, begin, end, size, whole):
        columns = [F.get(hashes, place).alias("mark"), place.alias("place")]
        if around:
            near = F.slice(hashes, begin + 1, end - begin)
            columns += [near.alias("near"), begin.alias("begin"), F.lit(size).alias("size"), whole.alias("whole")]
        return F.struct(*columns)

    def long_runs(hashes):
        n = F.size(hashes)
        starts = F.when(n >= run, F.sequence(F.lit(0), n - run)).otherwise(F.array().cast("array<int>"))
        places = F.array_distinct(F.transform(starts, lambda i: _last_least(hashes, i, run)))

        def wide(p):
            return row(hashes, p, F.greatest(p - (run - 1), F.lit(0)), F.least(p + run, n), run, F.lit(False))

        return F.transform(places, wide)

    def short_runs(hashes, words, size):
        """Windows of fewer lines with many words, and documents that have no more lines."""
        n = F.size(hashes)
        starts = F.when(n >= size, F.sequence(F.lit(0), n - size)).otherwise(F.array().cast("array<int>"))
        held = lambda i: reduce(Column.__add__, [F.get(words, i + k) for k in range(size)])
        many = F.filter(starts, lambda i: held(i) >= short_words)
        own = lambda i, whole: row(hashes, _last_least(hashes, i, size), i, i + size, size, F.lit(whole))
        copies = F.filter(starts, lambda i: n == size)
        return [F.transform(many, lambda i: own(i, False)), F.transform(copies, lambda i: own(i, True))]

    if short_words is None:
        found = let(F.transform(lines, lambda line: F.xxhash64(line)), long_runs)
    else:
        read = let(
            lines,
            lambda own: F.struct(
                F.transform(own, lambda line: F.xxhash64(line)).alias("hashes"),
                F.transform(own, _words).alias("words"),
            ),
        )
        found = let(
            read,
            lambda r: F.concat(
                long_runs(r["hashes"]),
                *[part for size in range(1, run) for part in short_runs(r["hashes"], r["words"], size)],
            ),
        )
    doc = F.struct(F.col("doc_id").alias("id"), F.xxhash64("text").alias("text")).alias("doc")
    return docs.select(doc, F.explode(found).alias("f")).select("doc", "f.*")


def extended(places: DataFrame) -> DataFrame:
    """Places extended to windows: document, first line (from 1), lines, key of the window."""
    first = F.sequence(F.lit(0), F.size("near") - F.col("size"))

    def window(i):
        part = F.slice("near", i + 1, F.col("size"))
        kind = F.when(F.col("whole"), "whole").otherwise("part")
        return F.struct(
            (F.col("begin") + i + 1).alias("line"),
            (F.col("place") - F.col("begin") - i).alias("at"),
            F.xxhash64(kind, part).alias("key"),
            F.xxhash64(kind, "size", part).alias("key2"),
            (F.col("size") - F.array_position(F.reverse(part), F.array_min(part))).alias("selected"),
        )

    made = places.select("doc", "size", F.explode(F.transform(first, window)).alias("w"))
    return made.filter(F.col("w.selected") == F.col("w.at")).select("doc", "size", "w.line", "w.key", "w.key2")


def repeated(docs: DataFrame, run: int = RUN, short_words: int | None = None) -> DataFrame:
    """Windows that have an earlier place: document, first line (from 1) and lines."""
    place = F.struct("doc", "place")
    shared = (
        fingerprints(docs, run, short_words, around=False)
        .groupBy("mark")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .filter(F.col("first") != F.col("last"))
        .select("mark")
    )
    windows = extended(inner_lookup(fingerprints(docs, run, short_words), shared, "mark"))
    here = F.struct("doc", "line")
    firsts = (
        windows.groupBy("key", "key2")
        .agg(F.min(here).alias("first"), F.max(here).alias("last"))
        .filter(F.col("first") != F.col("last"))
        .select("key", F.col("key2").alias("first_key2"), "first")
    )
    # By one half of the key; rows that differ in the other half go.
    return (
        inner_lookup(windows, firsts, "key")
        .filter((F.col("key2") == F.col("first_key2")) & (here > F.col("first")))
        .select("doc", "line", "size")
    )


def deduplicate(
    docs: DataFrame, run: int = RUN, counts: str | None = None, short_words: int | None = None
) -> DataFrame:
    """All columns of the documents with ``text`` less its repeated runs.

    ``short_words`` adds runs of fewer than ``run`` lines that hold so many words, and whole
    copies of documents of fewer than ``run`` lines, whatever their length.
    ``counts`` names a column to add, a struct of how many lines with a word there were
    (``n_lines``) and how many are deleted (``n_removed``).
    """
    cuts = repeated(docs.select("doc_id", "text"), run, short_words).groupBy("doc").agg(
        F.collect_set(F.struct("line", "size")).alias("cut")
    )
    cuts = cuts.select(
        F.col("doc.id").alias("cut_id"), F.col("doc.text").alias("cut_text"), "cut"
    )
    own = F.struct(*docs.columns)
    rows = docs.select(own.alias("row"))
    key = F.xxhash64("row.text")
    joined = rows.join(
        cuts, F.col("row.doc_id").eqNullSafe(F.col("cut_id")) & (key == F.col("cut_text")), "left"
    )

    def without(lines):
        worded = _worded(lines)
        gone = let(
            worded,
            lambda at: F.array_distinct(
                F.flatten(F.transform("cut", lambda w: F.slice(at, w["line"], w["size"])))
            ),
        )
        kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
        return F.struct(
            F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n").alias("text"),
            F.size(worded).cast("long").alias("n_lines"),
            F.size(gone).cast("long").alias("n_removed"),
        )

    n_lines = F.size(F.filter(_split(F.col("row.text")), lambda line: line.rlike(HAS_WORD)))
    whole = F.struct(
        F.col("row.text").alias("text"),
        n_lines.cast("long").alias("n_lines"),
        F.lit(0).cast("long").alias("n_removed"),
    )
    done = F.when(F.col("cut").isNull(), whole).otherwise(let(_split(F.col("row.text")), without))
    columns = [
        F.col("done.text").alias("text") if c == "text" else F.col("row").getField(c).alias(c)
        for c in docs.columns
    ]
    if counts:
        columns.append(F.struct("done.n_lines", "done.n_removed").alias(counts))
    return joined.select("row", done.alias("done")).select(*columns)
