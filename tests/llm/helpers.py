"""Small tables with the awkward cases that every operator must take."""

from pyspark.sql import DataFrame, SparkSession

from tests.conftest import TESTDATA

SMALL = f"{TESTDATA}/sf0.001"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 997}" for i in range(30_000))


def documents(spark: SparkSession, rows) -> DataFrame:
    """(id, text) rows as a documents table."""
    full = [(i, t, None, "src", None if t is None else len(t)) for i, t in rows]
    return spark.createDataFrame(full, DOCUMENTS)


def odd_rows() -> list[tuple]:
    """Null ids and texts, empty, very long, repeated and tied rows."""
    return [
        (1, None),
        (2, ""),
        (3, " \n\t\n "),
        (4, LONG),
        (5, LONG),
        (5, LONG),
        (6, "one"),
        (6, "another text under the same id"),
        (None, "a text without an id"),
        (None, None),
        (7, "é ü 日本 \u2581 🙂 \x00 \\ <|im_end|>"),
    ]


def clashing(df: DataFrame) -> DataFrame:
    """Extra columns named like what operators work with."""
    from pyspark.sql import functions as F

    names = [
        "row", "doc", "key", "cut", "done", "lines", "line", "w", "n", "id", "node", "part", "bucket",
        "failures", "measured", "n_words", "digest", "kept", "least", "a", "b", "ids", "score", "r",
    ]
    return df.withColumns({name: F.lit("extra") for name in names})


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], DOCUMENTS)


def texts(spark: SparkSession, sf_dir: str = SMALL) -> dict[int, str]:
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text or "" for r in rows}
