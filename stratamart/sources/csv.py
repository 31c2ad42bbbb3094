"""CSV sources: header, quoted fields that span lines, doubled quotes inside quotes."""

from collections import defaultdict
from collections.abc import Collection, Mapping
from concurrent.futures import ThreadPoolExecutor
from fnmatch import fnmatchcase
from functools import reduce
from urllib.parse import unquote, urlparse

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from stratamart.sources.csv_split import leaves_quote_open, lines_of, read_split_csv, runs
from stratamart.sources.csv_types import typed
from stratamart.specs import INGESTED_AT, MALFORMED, SOURCE_FILE, SOURCES, SourceSpec

# The dialect of the sources.
DIALECT = {"header": "true", "quote": '"', "escape": '"'}
#: Reading: an empty field is NULL and a quoted empty one is the empty text. Spark tells them
#: apart only if NULL is spelt by something else; no file holds this.
READ = {**DIALECT, "nullValue": "￾\u0000null", "emptyValue": ""}
#: Writing: blanks at the ends of a text are part of it.
WRITE = {**DIALECT, "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    infer_schema: bool = False,
    record_separator: str | None = None,
    split_files: bool = False,
) -> DataFrame:
    """Read CSV by header name; all columns are text unless ``infer_schema``, which gives
    every column the narrowest type that all its values read as (:mod:`stratamart.sources.csv_types`).

    Text keeps leading zeros and makes one broken row visible as such instead of changing
    a column's type; the cleaners give columns their declared type. Columns are bound by the
    header of each file, so files may order them differently or lack some.

    By default each file is one task, because a line end may be inside quotes. That suits
    drops of many files. For a few huge files there are two ways to read them in splits:
    ``record_separator`` if records end in something that does not occur inside fields (for
    example CR LF around fields with bare LF), else ``split_files``, which finds the record
    ends itself (see :mod:`stratamart.sources.csv_split`). Both ways return the same rows.
    """
    if split_files and record_separator is not None:
        raise ValueError("split_files finds record ends itself")
    if record_separator is not None:
        reader = spark.read.options(**READ).option("inferSchema", str(infer_schema).lower())
        return reader.option("lineSep", record_separator).csv(path)
    rows = read_records(spark, path, split_files)
    if infer_schema:
        rows = typed(rows, F.col(MALFORMED).isNull(), (MALFORMED, SOURCE_FILE))
    return rows.drop(MALFORMED, SOURCE_FILE)


def read_records(spark: SparkSession, path: str | list[str], split_files: bool) -> DataFrame:
    """Text columns, source file and, of a record whose number of fields is not that of its
    header, the raw text. Such a record keeps the fields it has."""
    parts = []
    for header, files in _by_header(spark, path).items():
        if split_files:
            parts.append(read_split_csv(spark, files, list(header), READ))
        else:
            schema = ", ".join("`{}` string".format(c.replace("`", "``")) for c in [*header, MALFORMED])
            reader = spark.read.options(**READ).option("multiLine", "true").schema(schema)
            rows = reader.option("columnNameOfCorruptRecord", MALFORMED).csv(files)
            # Spark refuses to read the raw text alone, so it is read with the first column.
            raw = F.element_at(F.array(F.col(MALFORMED), F.col(f"`{header[0]}`")), 1) if header else None
            rows = rows.withColumn(SOURCE_FILE, F.col("_metadata.file_path"))
            parts.append(rows if raw is None else rows.withColumn(MALFORMED, raw))
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    own = [c for c in every.columns if c not in (MALFORMED, SOURCE_FILE)]
    return every.select(*own, MALFORMED, SOURCE_FILE)


def _by_header(spark: SparkSession, path: str | list[str]) -> dict[tuple[str, ...], list[str]]:
    """Files by their header.

    One job finds the first line of every file that is not blank and groups files by it; each
    distinct line is then read once as a header, in one of its files. A header that goes on
    over more lines is read file by file.
    """
    reader = spark.read.options(**READ).option("multiLine", "true")
    files = sorted(unquote(f) for f in spark.read.text(path).inputFiles())
    groups = defaultdict(list)
    with ThreadPoolExecutor(max_workers=8) as pool:
        first_lines = _by_first_line(spark, path)
        samples = [found[0] for found in first_lines]
        for found, columns in zip(first_lines, pool.map(lambda f: tuple(reader.csv(f).columns), samples)):
            groups[columns] += found
    # A file without a record adds no columns, unless there are only such files.
    return {h: sorted(f) for h, f in groups.items() if h} or {(): files}


def _by_first_line(spark: SparkSession, path: str | list[str]) -> list[list[str]]:
    """Files that share their first line, or one by itself if that line leaves a quote open.

    Tasks send one line per file, found as they read its first split: nothing is sorted.
    """

    def firsts(batches):
        for _, run, is_first in runs(batches):
            if is_first:
                yield run.slice(0, 1).select([SOURCE_FILE, "line"])

    line = F.regexp_replace("text", r"\r\z", "").alias("line")
    begun = lines_of(spark, path).filter("_split = 0").select(SOURCE_FILE, "_split", "_length", line)
    first = begun.filter("line <> ''").mapInArrow(firsts, f"{SOURCE_FILE} string, line string")
    first = first.withColumnRenamed(SOURCE_FILE, "file")
    alone = F.when(leaves_quote_open(F.col("line")), F.col("file"))
    grouped = first.groupBy("line", alone.alias("alone")).agg(F.sort_array(F.collect_list("file")).alias("files"))
    return [[unquote(f) for f in r.files] for r in grouped.select("files").collect()]


def write_csv(df: DataFrame, path: str) -> None:
    """Write CSV in the same dialect, so that :func:`read_csv` returns equal text."""
    df.write.mode("overwrite").options(**WRITE).csv(path)


def with_ingest_metadata(df: DataFrame) -> DataFrame:
    """Add ingest time and source file to rows read from files."""
    return df.withColumns(
        {INGESTED_AT: F.current_timestamp(), SOURCE_FILE: F.col("_metadata.file_path")}
    )


def located(spark: SparkSession, raw_dir: str, spec: SourceSpec) -> str:
    """The one place that a source's pattern names: a file, or a directory of part files."""
    pattern = f"{raw_dir}/{spec.file_pattern}"
    try:
        files = spark.read.text(pattern).inputFiles()
    except AnalysisException as error:
        raise ValueError(f"{spec.name}: nothing matches {pattern}") from error
    names = set()
    for file in files:
        folders = unquote(urlparse(file).path).split("/")
        names.add([f for f in folders if fnmatchcase(f, spec.file_pattern)][-1])
    if len(names) != 1:
        raise ValueError(f"{spec.name}: {pattern} matches {sorted(names) or 'no file'}; name one in paths")
    return f"{raw_dir}/{names.pop()}"


def ingest(
    spark: SparkSession,
    raw_dir: str,
    paths: Mapping[str, str] | None = None,
    specs: Mapping[str, SourceSpec] = SOURCES,
    infer_schema: bool = False,
    whole_files: Collection[str] = (),
) -> dict[str, DataFrame]:
    """Bronze DataFrames for every source in the manifest, read in splits.

    ``paths`` overrides locations. ``whole_files`` names the sources to read with one task a
    file. Records with too few or too many fields carry their raw text in a column of their
    own, which the type check of bronze counts. ``infer_schema`` gives columns the types that
    all whole records read as, at the price of a pass over each source.
    """
    places = dict(paths or {})
    places |= {n: located(spark, raw_dir, spec) for n, spec in specs.items() if n not in places}

    def source(name: str) -> DataFrame:
        rows = read_records(spark, places[name], name not in whole_files)
        if infer_schema:
            rows = typed(rows, F.col(MALFORMED).isNull(), (MALFORMED, SOURCE_FILE))
        return rows.withColumn(INGESTED_AT, F.current_timestamp())

    return {name: source(name) for name in specs}
