from pyspark.sql import functions as F

import corpus_pipeline
from stratamart.llm import lines
from stratamart.llm.common import WORD, table
from stratamart.llm.queries import op3_line_dedup
from tests.conftest import TESTDATA
from tests.llm.helpers import SMALL, clashing, documents, empty, odd_rows


def test_runs_are_deleted_from_the_later_place(spark):
    run = "first line\nsecond line\n\nthird line"
    rows = [
        (1, f"start\n{run}\nend"),
        (2, f"other\n{run}\nfourth line"),
        (3, "first line\nsecond line"),
        (4, f"{run}\nsomething else\n{run}"),
    ]
    out = {r.doc_id: r for r in lines.deduplicate(documents(spark, rows), counts="lines").collect()}
    assert out[1].text == rows[0][1]
    assert out[2].text == "other\n\nfourth line" and out[2].lines.n_removed == 3
    assert out[3].text == rows[2][1]
    assert out[4].text == "\nsomething else\n"


def test_awkward_rows(spark):
    rows = odd_rows() + [(8, "a\nb\nc"), (8, "a\nb\nc"), (None, "a\nb\nc")]
    docs = clashing(documents(spark, rows))
    out = lines.deduplicate(docs)
    assert out.columns == docs.columns
    made = sorted((r.doc_id or 0, r.text or "") for r in out.collect())
    expected = [(i or 0, "" if i == 8 else t or "") for i, t in rows]
    assert made == sorted(expected)
    assert lines.deduplicate(empty(spark)).count() == 0


def brute(rows, run=3, short_words=50):
    """Texts and numbers of deleted lines, by comparing windows in the order of ids."""
    seen, out = set(), {}
    for doc, text in sorted(rows):
        every = text.split("\n")
        at = [i for i, line in enumerate(every) if line.split()]
        worded, gone = [every[i] for i in at], set()
        found = [(tuple(worded), 0)] if 0 < len(worded) < run else []
        found = [(("whole", *w), i) for w, i in found]
        for size in range(1, run + 1):
            for i in range(len(worded) - size + 1):
                window = tuple(worded[i : i + size])
                if size == run or sum(len(line.split()) for line in window) >= short_words:
                    found.append((window, i))
        for window, i in sorted(found, key=lambda f: f[1]):
            size = len(window) - (window[0] == "whole")
            if window in seen:
                gone |= set(at[i : i + size])
            seen.add(window)
        out[doc] = "\n".join(line for i, line in enumerate(every) if i not in gone), len(gone)
    return out


def test_short_runs_of_many_words_and_short_copies_are_deleted(spark):
    long = " ".join(f"w{i}" for i in range(50))
    half, rest = " ".join(f"h{i}" for i in range(30)), " ".join(f"r{i}" for i in range(20))
    rows = [
        (1, f"start\n{long}\nmiddle\n{half}\n\n{rest}\nend"),
        (2, f"other\n{long}\nbetween\n{half}\n{rest}"),
        (3, long),
        (4, f"{half}\nalone\n{rest} less"),
        (5, "two short\nlines"),
        (6, "two short\n\nlines"),
        (7, "two short\nlines\nand more"),
        (8, f"{long} more\n{long} more"),
        (9, "one"),
        (10, "one"),
    ]
    made = lines.deduplicate(documents(spark, rows), counts="lines", short_words=50).collect()
    out = {r.doc_id: (r.text, r.lines.n_removed) for r in made}
    assert out == brute(rows)
    assert out[2] == ("other\nbetween", 3) and out[3] == ("", 1)
    assert out[4][1] == 0 and out[6] == ("", 2) and out[7][1] == 0 and out[10] == ("", 1)


def test_short_runs_of_the_table(spark):
    docs = table(spark, SMALL, "documents").select("doc_id", "text")
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    made = lines.deduplicate(docs, counts="lines", short_words=20).collect()
    assert {r.doc_id: (r.text or "", r.lines.n_removed) for r in made} == brute(rows, 3, 20)


def test_pipeline_stage_deletes_short_runs(spark):
    long = " ".join(f"w{i}" for i in range(60))
    docs = documents(spark, [(1, f"a\n{long}\nb"), (2, f"c\n{long}\nd")])
    out = dict(corpus_pipeline.STAGES)["line_dedup"](spark, docs, SMALL).collect()
    assert {r.doc_id: r.text for r in out} == {1: f"a\n{long}\nb", 2: "c\nd"}


def test_joins_split_a_passage_of_many_documents(spark):
    rows = [(i, f"own {i}\nfirst line\nsecond line\nthird line\nlast {i}") for i in range(20_000)]
    rows += [(20_000 + i, "\n".join(f"{i} {k}" for k in range(9))) for i in range(2000)]
    rows += [(22_000 + i, t) for i, (_, t) in enumerate(rows[20_000:])]
    docs = documents(spark, rows).repartition(32)
    limits = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {key: spark.conf.get(key, None) for key in limits}
    for key, value in limits.items():
        spark.conf.set(key, value)
    try:
        found = lines.repeated(docs)
        n = found.count()
        found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert n == 19_999 + 2000 * 7
    final = plan.split("== Initial Plan ==")[0]
    assert "SortMergeJoin(skew=true) [mark" in final and "SortMergeJoin(skew=true) [key" in final


def test_words_are_counted_whatever_stands_between(spark):
    made = ["a b", " a b", "a b ", "a  b", "a\tb c", "a\x0bb", "a b\r", "é日　x y", "a", "  ", "a b c d"]
    df = spark.createDataFrame([(t,) for t in made], "line string")
    found = df.select(lines._words(F.col("line")).alias("n"), F.regexp_count("line", F.lit(WORD)).alias("exact"))
    assert all(r.n == r.exact for r in found.collect())


def test_no_long_line_stays_in_two_documents(spark):
    left = op3_line_dedup(spark, f"{TESTDATA}/sf0.01")
    line = F.explode(F.array_distinct(F.split("text", "\n"))).alias("line")
    again = left.select("doc_id", line).groupBy("line").agg(F.count_distinct("doc_id").alias("docs"))
    long = again.filter((F.col("docs") > 1) & (F.regexp_count("line", F.lit(WORD)) >= lines.SHORT_WORDS))
    assert long.count() == 0


def test_only_selected_lines_are_given(spark):
    """A fingerprint is the least hash of a window; of a long text about half of the lines."""
    text = "\n".join(f"line {i}" for i in range(3000))
    docs = documents(spark, [(1, text)])
    places = lines.fingerprints(docs, around=False).select("place").collect()
    hashes = [r.h for r in docs.select(F.explode(F.split("text", "\n")).alias("x")).select(F.xxhash64("x").alias("h")).collect()]
    wanted = {max(range(i, i + 3), key=lambda k: (-hashes[k], k)) for i in range(2998)}
    assert {r.place for r in places} == wanted and len(places) == len(wanted) < 0.6 * 3000
