"""What stages have made from what, so that a run can go on where an earlier one stopped.

An entry says: this stage made this version of a table from these inputs. Inputs are the
versions of the tables read and the settings that matter, for bronze the files of the source.
Stages work table by table, so after one source has been repaired only what depends on it is
made again.
"""

import json
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F

from stratamart.sources.layers import Layer, children

# The silver tables that each gold table is made from.
GOLD_INPUTS = {
    "dim_customer": ("customers",),
    "dim_product": ("products", "category_translation"),
    "dim_seller": ("sellers",),
    "dim_date": ("orders",),
    "fact_order_items": ("order_items", "orders"),
    "fact_payments": ("order_payments",),
    "fact_reviews": ("order_reviews",),
}

_ENTRY = "stage string, table_name string, inputs string, version string, row_count long"


@dataclass(frozen=True)
class Entry:
    inputs: str
    version: str
    rows: int


@dataclass
class Ledger:
    """Entries in a folder, one small file per stage and run. One run at a time writes it.

    ``made`` and ``skipped`` list what the present run did: (stage, table, rows).
    """

    location: str
    made: list[tuple[str, str, int]] = field(default_factory=list)
    skipped: list[tuple[str, str, int]] = field(default_factory=list)

    def entries(self, spark: SparkSession) -> dict[tuple[str, str], Entry]:
        """The latest entry of every stage and table."""
        numbers = self._numbers(spark)
        if not numbers:
            return {}
        rows = (
            spark.read.schema(f"{_ENTRY}, number int").json(self.location)
            .groupBy("stage", "table_name")
            .agg(F.max_by(F.struct("inputs", "version", "row_count"), "number").alias("last"))
        )
        return {(r.stage, r.table_name): Entry(*r["last"]) for r in rows.collect()}

    def _numbers(self, spark: SparkSession) -> list[int]:
        names = children(spark, self.location)
        return [int(n.partition("=")[2]) for n in names if n.startswith("number=")]

    def current(
        self, spark: SparkSession, stage: str, layer: Layer, inputs: Mapping[str, str | None]
    ) -> dict[str, Entry]:
        """Tables of a stage that were made from these inputs and whose version is still there."""
        last = self.entries(spark)
        found = {}
        for table, wanted in inputs.items():
            entry = last.get((stage, table))
            if wanted is not None and entry and entry.inputs == wanted:
                if entry.version in layer.versions(spark, table):
                    found[table] = entry
                    self.skipped.append((stage, table, entry.rows))
        return found

    def record(
        self, spark: SparkSession, stage: str, version: str, inputs: Mapping[str, str | None], rows: Mapping[str, int]
    ) -> None:
        """Note what was written; tables whose inputs have no name are not noted."""
        self.made += [(stage, table, n) for table, n in rows.items()]
        new = [(stage, t, inputs[t], version, n) for t, n in rows.items() if inputs[t] is not None]
        if new:
            number = max(self._numbers(spark), default=0) + 1
            entries = spark.createDataFrame(new, _ENTRY).coalesce(1)
            entries.write.mode("error").json(f"{self.location}/number={number}")

    def report(self, spark: SparkSession) -> DataFrame:
        """Tables per stage and what became of them in this run."""
        rows = [(*r, "made") for r in self.made] + [(*r, "skipped") for r in self.skipped]
        return spark.createDataFrame(rows, "stage string, table_name string, row_count long, action string")


def source_inputs(sources: Mapping[str, DataFrame]) -> dict[str, str | None]:
    """A name for the present content of every source: its plan and the paths, sizes and times
    of its files, these hashed by executors. None for a source that is not read from files."""
    return {name: _files(df) for name, df in sources.items()}


def _files(df: DataFrame) -> str | None:
    files = [unquote(f) for f in df.inputFiles()]
    if not files:
        return None
    listed = df.sparkSession.read.format("binaryFile").load(files)
    one = listed.agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("length").alias("bytes"),
        F.bit_xor(F.xxhash64("path", "length", "modificationTime")).alias("hash"),
    ).first()
    plan = re.sub(r"#\d+L?", "", df._jdf.queryExecution().analyzed().toString())
    return json.dumps({**one.asDict(), "columns": df.dtypes, "plan": plan})


def from_versions(versions: Mapping[str, str], tables: Sequence[str], **settings) -> str:
    """A name for stored inputs: the versions of tables, and settings."""
    return json.dumps({"versions": {t: versions[t] for t in tables}, **settings}, sort_keys=True)
