"""What became of the rows of each source: read = malformed + filtered + duplicate + written.

The points are observed in the job that writes the cleaned table, so nothing is read twice.
A point before the shuffle may count rows of a task again if the task is repeated after a lost
executor; ``row_ledger`` says whether the counts agree.
"""

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from stratamart.plans.silver import clean
from stratamart.sources.layers import Layer, new_version, observed
from stratamart.specs import PROCESSED_AT, SOURCES

_ROW = (
    "table_name string, read long, malformed long, filtered long, duplicate long, written long, "
    "reconciled boolean"
)


class Points:
    """Row counts at named points of a plan, known once the plan has run."""

    def __init__(self) -> None:
        self._seen: dict[str, Observation] = {}

    def watch(self, point: str, rows: DataFrame) -> DataFrame:
        self._seen[point] = Observation(f"{point}-{uuid.uuid4()}")
        return rows.observe(self._seen[point], F.count(F.lit(1)).alias("rows"))

    def __getitem__(self, point: str) -> int:
        return observed(self._seen[point], "rows")


def write_silver_counted(
    spark: SparkSession, layer: Layer, bronze: Mapping[str, DataFrame], normalise_translation: bool = False
) -> DataFrame:
    """Write the cleaned tables and publish them; one row of counts per table."""
    points = {name: Points() for name in bronze}
    cleaned = {
        name: clean(df, SOURCES[name], normalise_translation and name == "category_translation", points[name].watch)
        for name, df in bronze.items()
    }
    version = new_version()
    written = layer.write_all(cleaned, stamp=PROCESSED_AT, version=version)
    layer.commit(spark, list(written), version)
    rows = []
    for name, seen in points.items():
        read, whole, valid = seen["read"], seen["whole"], seen["valid"]
        parts = read - whole, whole - valid, valid - written[name], written[name]
        rows.append((name, read, *parts, min(parts) >= 0))
    return spark.createDataFrame(rows, _ROW)
