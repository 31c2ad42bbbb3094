"""Small helpers that several operators share."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from stratamart.sources.layers import remove, scratch_directory

#: Words are split at these code points only (space, tab, line ends, form feeds).
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions_for(spark: SparkSession, least: int = 1) -> int:
    """Shuffle partitions the session asks for: the deployment's measure of the input."""
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))


def let(value, body):
    """``body`` of a value that is evaluated once, also where body uses it for many items."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text):
    """Array column of the words of a text column; null counts as empty."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


class Steps:
    """Working tables of one run in the cluster's shared folder.

    A table is written and read again, which ends its lineage. ``drop`` removes one that no
    later step reads; the last ones stay for the result, which is lazy.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.root = spark, scratch_directory(spark)

    def store(self, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            remove(self.spark, f"{self.root}/{name}")
