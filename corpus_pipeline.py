"""A training corpus from ``documents``: filtered, deduplicated three ways, packed.

Every stage works on all that its predecessor kept and is written out before the next one
starts, so a lost executor costs a stage at most. ``n_chars`` follows the text. A document that
a stage has left without a word goes.

Null and repeated ids, null and empty texts, and repeated rows are defined per stage below. Row
by row they come out as the operators say; an empty table stays empty throughout.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from stratamart.llm import jaccard, lines, packing, quality, suffixes
from stratamart.llm.common import table
from stratamart.llm.graphs import stored

#: Near duplicates: five words a shingle, similarity of 0.8 or more.
SHINGLE, PERCENT = 5, 80


def _cut(docs: DataFrame, like: DataFrame) -> DataFrame:
    """Documents whose texts were cut: those that still hold a word, their length counted again."""
    kept = docs.filter(F.col("text").rlike(lines.HAS_WORD))
    counted = kept.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else kept
    return counted.select(*like.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy keeps.

    Every row is judged by its own text: a null or empty text has no words and goes, rows that
    share an id are kept or not each on their own, and a null id is kept if its text is.
    """
    return quality.filter_documents(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts less runs of lines that stand earlier, runs of one or two long lines included.

    A null id comes before all others; rows that share id and text are one document and keep
    the same lines. Whole copies lose all their lines and go, as do null and empty texts.
    """
    return _cut(lines.deduplicate(docs, short_words=lines.SHORT_WORDS), docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest id.

    A null id or text is linked with nothing and stays; rows that share the kept id all stay.
    """
    return jaccard.keep_one(docs, SHINGLE, PERCENT)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts less strings of 50 bytes or more that an earlier document holds.

    A null id has no place in the order: its row stays as it is and shortens no other. Rows
    that share an id are not compared with each other. What is left without a word goes.
    """
    return _cut(suffixes.deduplicate(docs), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in windows of 1024 tokens, each row packed on its own."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("ngram_jaccard", ngram_jaccard),
    ("suffix_dedup", suffix_dedup),
    ("packing", pack),
]

#: SQL has no tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
