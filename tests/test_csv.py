"""CSV: line ends and quotes inside fields, leading zeros, manifest ingest, split reading."""

import re
import uuid

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from stratamart.sources import csv, csv_split
from stratamart.sources.csv import ingest, read_csv, write_csv
from stratamart.sources.csv_types import inferred, typed
from stratamart.sources.tpch import table
from stratamart.specs import INGESTED_AT, MALFORMED, SOURCE_FILE, SOURCES
from tests.conftest import TESTDATA

SF_DIR = f"{TESTDATA}/sf0.01"


def same_rows(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.fixture(scope="module")
def one_file(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("csv") / "documents")
    write_csv(table(spark, SF_DIR, "documents").coalesce(1), path)
    return path


@pytest.fixture
def split_size(spark):
    key, cost = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"
    before = spark.conf.get(key), spark.conf.get(cost)

    def set_size(size):
        spark.conf.set(key, size)
        spark.conf.set(cost, "1KB")

    yield set_size
    spark.conf.set(key, before[0])
    spark.conf.set(cost, before[1])


def test_line_reader_breaks_records_and_multiline_reader_does_not(spark, one_file):
    documents = table(spark, SF_DIR, "documents")
    plain = spark.read.option("header", True).option("escape", '"').csv(one_file)
    assert plain.count() > documents.count()
    back = read_csv(spark, one_file).withColumn("doc_id", F.col("doc_id").cast("long"))
    assert same_rows(back.select("doc_id", "text"), documents.select("doc_id", "text"))


@pytest.mark.parametrize("size", ["64MB", "64KB", "3KB"])
def test_split_reader_returns_the_same_rows(spark, one_file, split_size, size):
    """3 KB splits are smaller than many records, so records span several splits."""
    whole = read_csv(spark, one_file)
    split_size(size)
    split = read_csv(spark, one_file, split_files=True)
    assert split.columns == whole.columns
    assert same_rows(split, whole)


def test_split_reader_on_several_files_with_crlf_and_blank_lines(spark, tmp_path, split_size):
    files = {
        "a.csv": 'id,note\r\n01,"x\r\n\r\ny ""quoted"""\r\n\r\n02,plain\r\n  \r\n',
        "b.csv": 'id,note\r\n03,"one, two"\r\n04,\r\n05,"last\nline"',
    }
    for name, text in files.items():
        (tmp_path / name).write_bytes(text.encode())
    whole = read_csv(spark, str(tmp_path))
    split_size("8B")
    split = read_csv(spark, str(tmp_path), split_files=True)
    assert same_rows(split, whole)
    rows = {r.id: r.note for r in split.collect()}
    assert rows == {
        "01": 'x\n\ny "quoted"',
        "02": "plain",
        "03": "one, two",
        "04": None,
        "05": "last\nline",
        "  ": None,
    }


def test_split_reader_keeps_cr_inside_fields_of_lf_files(spark, tmp_path, split_size):
    (tmp_path / "f.csv").write_bytes(b'id,note\n1,"a\r\nb"\n2,"c\rd"\n')
    whole = read_csv(spark, str(tmp_path))
    split_size("8B")
    split = read_csv(spark, str(tmp_path), split_files=True)
    assert same_rows(split, whole)
    assert {r.note for r in split.collect()} == {"a\r\nb", "c\rd"}


def test_record_separator_splits_on_it_only(spark, tmp_path):
    (tmp_path / "f.csv").write_bytes(b'id,note\r\n1,"a\nb"\r\n2,c\r\n')
    rows = read_csv(spark, str(tmp_path), record_separator="\r\n").collect()
    assert [(r.id, r.note) for r in rows] == [("1", "a\nb"), ("2", "c")]


def test_split_reader_takes_no_other_mode(spark):
    with pytest.raises(ValueError):
        read_csv(spark, "anywhere", split_files=True, record_separator="\r\n")


def test_codes_keep_leading_zeros_unless_inferred(spark, tmp_path):
    (tmp_path / "f.csv").write_text("zip\n01310\n")
    assert read_csv(spark, str(tmp_path)).first().zip == "01310"
    assert read_csv(spark, str(tmp_path), infer_schema=True).first().zip == 1310


def test_ingest_follows_the_manifest(spark, tmp_path):
    for spec in SOURCES.values():
        file = tmp_path / spec.file_pattern.replace("*", "public_")
        file.write_text(",".join(spec.types) + "\n" + ",".join("1" for _ in spec.types) + "\n")
    bronze = ingest(spark, str(tmp_path), whole_files={"order_reviews"})
    assert list(bronze) == list(SOURCES) and len(bronze) == 9
    for name, df in bronze.items():
        row = df.first()
        assert df.count() == 1
        assert row[INGESTED_AT] is not None
        assert row[SOURCE_FILE].endswith(".csv")
        assert set(SOURCES[name].types) < set(df.columns)


def _both(spark, path, split_size, sizes=("8B", "64B", "3KB")):
    whole = read_csv(spark, path)
    rows = sorted(map(str, whole.collect()))
    for size in sizes:
        split_size(size)
        split = read_csv(spark, path, split_files=True)
        assert split.columns == whole.columns
        assert sorted(map(str, split.collect())) == rows, size
    return whole


def test_a_stray_quote_is_text(spark, tmp_path, split_size):
    (tmp_path / "f.csv").write_text('id,note\n1,5" pipe\n2,b\n3,"c\n""d"""\n4,e"\n')
    rows = {r.id: r.note for r in _both(spark, str(tmp_path), split_size).collect()}
    assert rows == {"1": '5" pipe', "2": "b", "3": 'c\n"d"', "4": 'e"'}


def test_blank_lines_before_the_header(spark, tmp_path, split_size):
    (tmp_path / "f.csv").write_text("\n\n\nid,note\n1,a\n\n2,b\n")
    rows = {r.id: r.note for r in _both(spark, str(tmp_path), split_size).collect()}
    assert rows == {"1": "a", "2": "b"}


def test_columns_are_bound_by_each_file_s_header(spark, tmp_path, split_size):
    (tmp_path / "a.csv").write_text("id,score,note\n1,5,x\n")
    (tmp_path / "b.csv").write_text("id,note,score\n2,y,4\n")
    (tmp_path / "c.csv").write_text("note,id\nz,3\n")
    found = _both(spark, str(tmp_path), split_size).select("id", "score", "note")
    assert sorted(map(tuple, found.collect())) == [("1", "5", "x"), ("2", "4", "y"), ("3", None, "z")]


def test_texts_come_back_as_written(spark, tmp_path, split_size):
    texts = ["  pad  ", " x\ny ", "\ttab", "", None, '"', '""', "a,b", " ", "\\", "é\n"]
    rows = list(enumerate(texts))
    write_csv(spark.createDataFrame(rows, "id long, note string").coalesce(1), str(tmp_path / "t"))
    back = _both(spark, str(tmp_path / "t"), split_size)
    assert {int(r.id): r.note for r in back.collect()} == dict(rows)


_plain = st.text("ab\" \t'", min_size=1, max_size=6).filter(lambda t: t.strip() == t and t[0] != '"')
_quoted = st.text('ab",\n', max_size=8).map(lambda t: '"' + t.replace('"', '""') + '"')
_records = st.lists(st.tuples(_plain | _quoted, _plain | _quoted | st.just("")), min_size=1, max_size=12)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(_records, st.integers(0, 2))
def test_both_readers_agree(spark, tmp_path, split_size, records, blank):
    folder = tmp_path / uuid.uuid4().hex
    folder.mkdir()
    lines = ["one,two", *[f"{a},{b}" for a, b in records]]
    (folder / "f.csv").write_text("\n" * blank + "\n".join(lines) + "\n", newline="\n")
    assert _both(spark, str(folder), split_size).count() == len(records)


def test_a_source_has_one_place(spark, tmp_path):
    spec = {"orders": SOURCES["orders"]}
    with pytest.raises(ValueError, match="nothing matches"):
        ingest(spark, str(tmp_path), specs=spec)
    (tmp_path / "public_orders_dataset.csv").mkdir()
    for part in ("a", "b"):
        (tmp_path / "public_orders_dataset.csv" / f"{part}.csv").write_text("order_id\n1\n")
    assert ingest(spark, str(tmp_path), specs=spec)["orders"].count() == 2
    (tmp_path / "old_orders_dataset.csv").write_text("order_id\n2\n")
    with pytest.raises(ValueError, match="old_orders_dataset.csv"):
        ingest(spark, str(tmp_path), specs=spec)
    named = {"orders": str(tmp_path / "old_orders_dataset.csv")}
    assert ingest(spark, str(tmp_path), paths=named, specs=spec)["orders"].first().order_id == "2"


def jobs_of(spark, action):
    """The result of an action and the number of Spark jobs it started."""
    group = str(uuid.uuid4())
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        result = action()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return result, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


@pytest.mark.parametrize("split", [False, True])
def test_headers_of_many_files_take_few_jobs(spark, tmp_path, split):
    """500 files with three headers, one over two lines, some empty or with blank lines first."""
    heads = ["a,b,c", "c,a,b", '"a","b"']
    for i in range(500):
        columns = heads[i % 3].replace('"', "").split(",")
        row = ",".join(f"{c}{i}" for c in columns)
        (tmp_path / f"f {i} 100%.csv").write_text("\n" * (i % 2) + heads[i % 3] + "\r\n" * (i % 4 == 0) + f"\n{row}\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "two.csv").write_text('a,"b\nb"\nx,y\n')
    groups = csv._by_header(spark, str(tmp_path))
    assert {h: len(f) for h, f in groups.items()} == {
        ("a", "b", "c"): 167, ("c", "a", "b"): 167, ("a", "b"): 166, ("a", "b\nb"): 1,
    }
    found = csv._by_first_line(spark, str(tmp_path))
    _, jobs = jobs_of(spark, lambda: csv._by_first_line(spark, str(tmp_path)))
    assert len(found) == 4 and jobs <= 4
    rows = read_csv(spark, str(tmp_path), split_files=split)
    assert rows.count() == 501 and rows.filter("a IS NULL").count() == 0


# Texts of a column and the type that all of them read as.
TYPED = [
    (["1", "-7", None], "int"),
    (["01310"], "int"),
    (["1", "3000000000"], "bigint"),
    (["1", "2.5"], "double"),
    (["1e3", ".5"], "double"),
    (["99999999999999999999"], "double"),
    (["2020-01-31"], "date"),
    (["2020-01-31", "2020-02-01 10:00:00"], "timestamp_ntz"),
    (["2020-01-31T10:00"], "timestamp_ntz"),
    (["2020-02-30"], "string"),
    (["2020-01-31", "7"], "string"),
    (["true", "FALSE"], "boolean"),
    (["true", "1"], "string"),
    (["1", " 2"], "string"),
    (["NaN"], "string"),
    ([""], "string"),
    ([None], "string"),
]


@pytest.mark.parametrize("values, wanted", TYPED)
def test_inferred_types(spark, values, wanted):
    """The same for any order and partitioning of the rows."""
    for some in (values, values[::-1]):
        rows = spark.createDataFrame([(v,) for v in some], "`a.b` string").repartition(2)
        assert inferred(rows, ["a.b"]) == {"a.b": wanted}
        assert typed(rows).dtypes == [("a.b", wanted)]


@pytest.mark.parametrize("split", [False, True])
def test_broken_records_do_not_change_a_type(spark, tmp_path, split):
    (tmp_path / "f.csv").write_text("n,t\n1,x\n2,y\nbroken\n3,z,more\n")
    rows = read_csv(spark, str(tmp_path), infer_schema=True, split_files=split)
    assert rows.dtypes == [("n", "int"), ("t", "string")]
    assert sorted((r.n or 0, r.t or "") for r in rows.collect()) == [(0, ""), (1, "x"), (2, "y"), (3, "z")]


def test_ingest_infers_in_splits(spark, tmp_path):
    for spec in SOURCES.values():
        file = tmp_path / spec.file_pattern.replace("*", "public_")
        file.write_text(",".join(spec.types) + "\n" + ",".join("1" for _ in spec.types) + "\n")
    bronze = ingest(spark, str(tmp_path), infer_schema=True)
    own = {c: t for c, t in bronze["order_items"].dtypes if c in SOURCES["order_items"].types}
    assert set(own.values()) == {"int"}
    assert {MALFORMED, SOURCE_FILE, INGESTED_AT} <= set(bronze["orders"].columns)


def test_no_text_is_shuffled_by_split(spark, tmp_path, split_size):
    """Only the pieces at the edges of splits are, and nothing of first lines is sorted."""
    (tmp_path / "f.csv").write_text("id,note\n" + "".join(f'{i},"a\n""{i}"""\n{i},plain\n' for i in range(2000)))
    split_size("8KB")
    rows = read_csv(spark, str(tmp_path), split_files=True)
    assert rows.count() == 4000
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and not re.search(r"Exchange hashpartitioning\([^)]*_split", plan)
    lines = csv_split.lines_of(spark, str(tmp_path))
    edges = csv_split._edges(lines, csv_split._split_states(csv_split._composed(lines)))
    splits = lines.select("_split").distinct().count()
    assert splits > 5 and edges.count() <= 2 * splits


def test_splits_cut_in_another_way_raise(spark, tmp_path, split_size):
    (tmp_path / "f.csv").write_text("id,note\n" + "".join(f'{i},"a\nb"\n' for i in range(200)))
    split_size("256B")
    states = csv_split._split_states(csv_split._composed(csv_split.lines_of(spark, str(tmp_path))))
    kept = spark.createDataFrame(states.collect(), states.schema)
    split_size("512B")
    lines = csv_split.lines_of(spark, str(tmp_path))
    for read in (csv_split._inside, csv_split._edges):
        with pytest.raises(Exception, match="other splits"):
            read(lines, kept).collect()
