"""Multi-line CSV read in splits.

A quoted field may hold line ends, so Spark's multi-line reader gives each file to one task.
Here the file is read as lines, in ordinary splits, and the records are put together again:

1. Whether a line end is inside a field depends on how the line began. A quote opens a field
   only at the field's start; elsewhere in an unquoted field it is text. So each line is a
   transition: for either state at its begin (outside or inside a quoted field) the state at
   its end. The transitions of a split compose to one (a small row per split), and composed
   over the splits of a file they tell in which state each split begins.
2. The lines are read again, each split with the state it begins in, and the task that reads a
   split joins the lines of its records. No text is shuffled, sorted or kept for that.
3. Only the pieces at the two edges of a split can belong to a record that crosses into the
   next one. They alone are shuffled and joined across splits.

The rows of splits are broadcast: some 200 bytes a split, whatever it holds. A split that the
reads do not cut alike (the session's parallelism changed in between) raises.

No task holds more text than a batch of lines and one record, or the edge pieces of one file
(two records per split).
"""

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from stratamart.specs import MALFORMED, SOURCE_FILE

_SPLIT = [SOURCE_FILE, "_split", "_length"]
_SPLIT_TYPES = f"{SOURCE_FILE} string, _split long, _length long"
# States within a record: at a field's start, in an unquoted field, in a quoted one, after a
# quote in a quoted one (its end, or the first of two).
_START, _PLAIN, _QUOTED, _CLOSING = range(4)
#: What is known of a split. Both reads with states take all of it, so that it is made once.
_STATE = ["entry", "ends_inside", "first", "last", "single", "crlf", "header_line"]


def read_split_csv(
    spark: SparkSession, path: str | list[str], columns: list[str], dialect: Mapping[str, str]
) -> DataFrame:
    """Text columns, raw text of malformed records, and source file of CSV files.

    Each file begins with a header: its first record that is not blank.
    """
    lines = lines_of(spark, path)
    states = _split_states(_composed(lines))
    records = _inside(lines, states).unionByName(_joined_across_splits(_edges(lines, states)))
    names = ", ".join("`{}` string".format(c.replace("`", "``")) for c in [*columns, MALFORMED])
    options = {**dialect, "columnNameOfCorruptRecord": MALFORMED}
    row = F.from_csv("text", names, options)
    return (
        records.filter(F.col("text") != "")
        .select(row.alias("_row"), SOURCE_FILE)
        .select("_row.*", SOURCE_FILE)
    )


def _end_state(line: Column, begin: int) -> Column:
    """State at the end of a line that begins in a state."""

    def step(state: Column, token: Column) -> Column:
        quote, comma = token == '"', token == ","
        return (
            F.when(state == _QUOTED, F.when(quote, _CLOSING).otherwise(_QUOTED))
            .when(comma, F.lit(_START))
            .when((state == _START) & quote, F.lit(_QUOTED))
            .when((state == _CLOSING) & quote, F.lit(_QUOTED))
            .otherwise(F.lit(_PLAIN))
        )

    tokens = F.regexp_extract_all(line, F.lit(r'[",]|[^",]+'), F.lit(0))
    return F.aggregate(tokens, F.lit(begin), step)


def leaves_quote_open(line: Column) -> Column:
    """Whether a line that begins a record ends within a quoted field."""
    return F.contains(line, F.lit('"')) & (_end_state(line, _START) == _QUOTED)


def lines_of(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines, in the order of their split, and the split."""
    return (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias(SOURCE_FILE),
            F.col("_metadata.file_block_start").alias("_split"),
            F.col("_metadata.file_block_length").alias("_length"),
            F.col("value").alias("text"),
        )
    )


def _turn(line: Column, apart: Column | None = None) -> Column:
    """Transition of a line: 0 or 1 is the state at its end where that does not depend on the
    one at its begin, 2 leaves the state as it is, 3 swaps it. Lines are looked at where
    ``apart`` holds and are taken to leave the state elsewhere."""
    looked = F.contains(line, F.lit('"')) if apart is None else apart & F.contains(line, F.lit('"'))
    outside = (_end_state(line, _START) == _QUOTED).cast("int")
    inside = (_end_state(line, _QUOTED) == _QUOTED).cast("int")
    ends = F.when(looked, F.struct(outside.alias("outside"), inside.alias("inside")))
    return F.transform(
        F.array(ends),
        lambda e: F.when(e.isNull(), 2)
        .when(e["outside"] == e["inside"], e["outside"])
        .when(e["outside"] < e["inside"], 2)
        .otherwise(3),
    )[0].cast("int")


def _after(turns: np.ndarray, entry: int) -> np.ndarray:
    """States after each of some lines in a row that begin in a state."""
    swaps = np.cumsum(turns == 3)
    last = np.maximum.accumulate(np.where(turns < 2, np.arange(len(turns)), -1))
    since = np.where(last < 0, entry + swaps, turns[last] + swaps - swaps[last])
    return since % 2


Run = tuple[tuple, pa.RecordBatch, bool]


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[Run]:
    """Lines of one split in a row: the split, some of its lines, whether they are the first."""
    current = None
    for batch in batches:
        if not batch.num_rows:
            continue
        marks = np.zeros(batch.num_rows, bool)
        marks[0] = True
        for name in _SPLIT:
            column = batch.column(name)
            marks[1:] |= pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(False)
        starts = np.flatnonzero(marks).tolist()
        for start, end in zip(starts, [*starts[1:], batch.num_rows]):
            split = tuple(batch.column(name)[start].as_py() for name in _SPLIT)
            yield split, batch.slice(start, end - start), split != current
            current = split


def _composed(lines: DataFrame) -> DataFrame:
    """A row per split: the transition from its begin to its end, and the records it holds.

    For either state at its begin: ``first``, the number of the line that begins its first
    record, ``last``, that of its last one (NULL if none begins), and whether each line is a
    record.
    """
    names = ("fixed", "swaps", "first_0", "last_0", "first_1", "last_1", "single", "first_ends_in_cr", "first_line")
    types = ("int", "int", "long", "long", "long", "long", "boolean", "boolean", "long")

    def begun(split: tuple, run: pa.RecordBatch) -> dict:
        cr = run.column("is_cr")[0].as_py()
        return dict(zip(names, (None, 0, None, None, None, None, True, cr, None))) | {"split": split, "n": 0}

    def finished(state: dict) -> pa.RecordBatch:
        values = [*state["split"], *[state[n] for n in names]]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), *[pa.int64()] * 4, pa.bool_(), pa.bool_(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], [*_SPLIT, *names])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for split, run, is_first in runs(batches):
            if is_first:
                if state:
                    yield finished(state)
                state = begun(split, run)
            turns = run.column("turn").to_numpy()
            fixed, swaps, n = state["fixed"], state["swaps"], state["n"]
            for entry in (0, 1):
                now = (entry if fixed is None else fixed) + swaps
                after = _after(turns, now % 2)
                begins = np.flatnonzero(np.concatenate([[now % 2], after[:-1]]) == 0)
                if len(begins):
                    if state[f"first_{entry}"] is None:
                        state[f"first_{entry}"] = n + int(begins[0])
                    state[f"last_{entry}"] = n + int(begins[-1])
                if entry == 0:
                    state["single"] = state["single"] and not after.any()
            known = np.flatnonzero(turns < 2)
            if len(known):
                state["fixed"], swaps = int(turns[known[-1]]), 0
                turns = turns[known[-1] + 1 :]
            state["swaps"] = (swaps + int((turns == 3).sum())) % 2
            if state["first_line"] is None:
                filled = np.flatnonzero(~run.column("is_blank").to_numpy(False))
                state["first_line"] = n + int(filled[0]) if len(filled) else None
            state["n"] += run.num_rows
        if state:
            yield finished(state)

    line = F.col("text")
    told = lines.select(
        *_SPLIT, _turn(line).alias("turn"), line.endswith("\r").alias("is_cr"), line.isin("", "\r").alias("is_blank")
    )
    schema = ", ".join([_SPLIT_TYPES, *[f"{n} {t}" for n, t in zip(names, types)]])
    return told.mapInArrow(task, schema)


def _split_states(composed: DataFrame) -> DataFrame:
    """Per split: the state it begins in, whether it ends inside a record, where its first and
    last record begin, the file's header line, its line ends.

    If a file's first line ends in CR LF, every CR LF is read as LF, as Spark's own reader
    does.
    """
    in_file = Window.partitionBy(SOURCE_FILE).orderBy("_split")
    so_far = in_file.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    turned = composed.withColumn(
        "turned", F.sum(F.when(F.col("fixed").isNull(), F.col("swaps")).otherwise(0)).over(so_far)
    )
    state = (F.col("fixed") + F.col("swaps")) % 2
    known = F.when(F.col("fixed").isNotNull(), F.struct(state.alias("fixed"), "turned"))
    ended = turned.withColumn("known", F.last(known, ignorenulls=True).over(so_far))
    since = F.col("turned") - F.coalesce(F.col("known.turned"), F.lit(0))
    ends = ((F.coalesce(F.col("known.fixed"), F.lit(0)) + since) % 2).cast("int")
    outside = F.col("entry") == 0
    header_split = F.min(F.when(F.col("first_line").isNotNull(), F.col("_split"))).over(
        Window.partitionBy(SOURCE_FILE)
    )
    return (
        ended.withColumn("ends", ends)
        .withColumn("entry", F.coalesce(F.lag("ends").over(in_file), F.lit(0)))
        .select(
            *_SPLIT,
            "entry",
            (F.col("ends") == 1).alias("ends_inside"),
            F.when(outside, F.col("first_0")).otherwise(F.col("first_1")).alias("first"),
            F.when(outside, F.col("last_0")).otherwise(F.col("last_1")).alias("last"),
            (outside & F.col("single")).alias("single"),
            F.first("first_ends_in_cr").over(so_far).alias("crlf"),
            F.when(F.col("_split") == header_split, F.col("first_line")).alias("header_line"),
        )
    )


def _placed(lines: DataFrame, states: DataFrame) -> DataFrame:
    """Lines with what is known of their split; the text as bytes."""
    # Names the file, so that the optimizer does not try the expression on missing states.
    unknown = F.raise_error(F.concat(F.lit("cut into other splits than before: "), F.col(SOURCE_FILE)))
    cut = F.col("crlf") & F.col("text").endswith("\r")
    text = F.when(cut, F.regexp_replace("text", r"\r\z", "")).otherwise(F.col("text"))
    known = lines.join(F.broadcast(states), _SPLIT, "left")
    entry = F.coalesce("entry", unknown).alias("entry")
    return known.select(*_SPLIT, entry, *_STATE[1:], "text", text.cast("binary").alias("line"))


def _inside(lines: DataFrame, states: DataFrame) -> DataFrame:
    """Records that begin and end in one split, less the header."""

    def joined(text: pa.Array, starts: np.ndarray, end: int) -> pa.Array:
        """Lines from each start to the next one as one text."""
        if len(starts) == end and not starts[:1].any():
            return text.slice(0, end)
        return pc.binary_join(pa.ListArray.from_arrays(pa.array([*starts, end], pa.int32()), text), b"\n")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Of the split: its state, the lines before, and the record that is open, if any.
        state, n, begun, pieces = 0, 0, None, []

        def given(split: tuple, records: pa.Array) -> pa.RecordBatch:
            files = pa.array([split[0]], pa.string()).take(pa.array(np.zeros(len(records), np.int64)))
            return pa.RecordBatch.from_arrays([files, records], [SOURCE_FILE, "text"])

        own = header = None
        for split, run, is_first in runs(batches):
            if is_first:
                if pieces and state == 0 and not is_header(begun, n, header):
                    yield given(own, pa.array([b"\n".join(pieces)], pa.binary()))
                own, header = split, run.column("header_line")[0].as_py()
                state, n, begun, pieces = run.column("entry")[0].as_py(), 0, None, []
            after = _after(run.column("turn").to_numpy(), state)
            text = run.column("line")
            starts = np.flatnonzero(np.concatenate([[state], after[:-1]]) == 0)
            # What comes before the first start goes on with the open record.
            head = int(starts[0]) if len(starts) else run.num_rows
            if begun is not None and head:
                pieces.append(b"\n".join(text.slice(0, head).to_pylist()))
            if len(starts):
                if begun is not None and not is_header(begun, n + head, header):
                    yield given(split, pa.array([b"\n".join(pieces)], pa.binary()))
                if len(starts) > 1:
                    last = int(starts[-1])
                    records = joined(text, starts[:-1], last)
                    if header is not None and n + head <= header < n + last:
                        at = int(np.searchsorted(starts, header - n, "right")) - 1
                        records = pa.concat_arrays([records.slice(0, at), records.slice(at + 1)])
                    yield given(split, records)
                begun = n + int(starts[-1])
                pieces = [b"\n".join(text.slice(int(starts[-1])).to_pylist())]
            state, n = int(after[-1]), n + run.num_rows
        if pieces and state == 0 and not is_header(begun, n, header):
            yield given(own, pa.array([b"\n".join(pieces)], pa.binary()))

    def is_header(begin: int, end: int, header: int | None) -> bool:
        return header is not None and begin <= header < end

    # Where each line is a record, no line need be looked at.
    turn = _turn(F.col("text"), ~F.col("single")).alias("turn")
    rows = _placed(lines, states).select(*_SPLIT, *_STATE, turn, "line")
    whole = rows.mapInArrow(task, f"{SOURCE_FILE} string, text binary")
    return whole.select(SOURCE_FILE, F.col("text").cast("string").alias("text"))


def _edges(lines: DataFrame, states: DataFrame) -> DataFrame:
    """Pieces of records that cross the edges of splits: number 0 continues the split before,
    number 1 begins a record that the split does not end."""
    kinds = {SOURCE_FILE: pa.string(), "_split": pa.int64(), "_record": pa.int64(), "text": pa.binary(), "is_header": pa.bool_()}

    def finished(split: tuple, header: int | None, parts: dict) -> Iterator[pa.RecordBatch]:
        for record, (begin, end, texts) in parts.items():
            is_header = header is not None and begin <= header < end
            values = [*split[:2], record, b"\n".join(texts), is_header]
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds.values())], [*kinds])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, header, n, parts = None, None, 0, {}
        for split, run, is_first in runs(batches):
            if is_first:
                yield from finished(own, header, parts)
                own, header, n, parts = split, run.column("header_line")[0].as_py(), 0, {}
            first, last, ends_inside = (run.column(c)[0].as_py() for c in ("first", "last", "ends_inside"))
            tail = last if ends_inside else None
            end = n + run.num_rows
            spans = {0: (0, end if first is None else first), 1: (end if tail is None else tail, end)}
            for record, (begin, until) in spans.items():
                begin, until = max(begin, n), min(until, end)
                if begin < until:
                    texts = run.column("line").slice(begin - n, until - begin).to_pylist()
                    since, _, before = parts.get(record, (begin, begin, []))
                    parts[record] = (since, until, [*before, b"\n".join(texts)])
            n = end
        yield from finished(own, header, parts)

    rows = _placed(lines, states).filter((F.col("entry") == 1) | F.col("ends_inside"))
    pieces = rows.select(*_SPLIT, *_STATE, "line").mapInArrow(
        task, f"{SOURCE_FILE} string, _split long, _record long, text binary, is_header boolean"
    )
    return pieces.withColumn("text", F.col("text").cast("string"))


def _joined_across_splits(edges: DataFrame) -> DataFrame:
    """Join each piece that begins a record with the continuations that follow it."""
    place = ["_split", "_record"]
    so_far = Window.partitionBy(SOURCE_FILE).orderBy(*place)
    chained = edges.withColumn(
        "_chain", F.sum(F.when(F.col("_record") > 0, 1).otherwise(0)).over(so_far)
    )
    ordered = F.array_sort(F.collect_list(F.struct(*place, "text")))
    return (
        chained.groupBy(SOURCE_FILE, "_chain")
        .agg(ordered.alias("chain"), F.max("is_header").alias("is_header"))
        .filter(~F.col("is_header"))
        .select(SOURCE_FILE, F.array_join(F.transform("chain", lambda piece: piece["text"]), "\n").alias("text"))
    )
