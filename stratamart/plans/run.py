"""The staged run: bronze, silver, gold, checks, publish. Each stage reads the one before."""

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from stratamart.lazy import LazyTables
from stratamart.plans.gold import Gold, gold_from_silver, gold_from_tables
from stratamart.plans.ledger import GOLD_INPUTS, Ledger, from_versions, source_inputs
from stratamart.plans.quality import (
    bronze_type_results,
    enforce,
    gold_suite,
    silver_suite,
    union_results,
)
from stratamart.plans.silver import silver as clean_all
from stratamart.sources.jdbc import JdbcTarget
from stratamart.sources.layers import Layer, new_version
from stratamart.specs import GOLD_TABLES, LOADED_AT, METADATA_COLUMNS, PROCESSED_AT

Layout = Mapping[str, Sequence[str]]
Publisher = Callable[[SparkSession, dict[str, DataFrame], dict[str, int]], dict[str, int]]


@dataclass(frozen=True)
class Lake:
    bronze: Layer
    silver: Layer
    gold: Layer

    @classmethod
    def under(cls, root: str, fmt: str = "parquet") -> "Lake":
        return cls(*[Layer(f"{root}/{name}", fmt) for name in ("bronze", "silver", "gold")])


def write_bronze(lake: Lake, sources: Mapping[str, DataFrame], version: str | None = None) -> dict[str, int]:
    return lake.bronze.write_all(sources, version=version)


def write_silver(
    spark: SparkSession,
    lake: Lake,
    tables: Sequence[str],
    normalise_translation: bool = False,
    version: str | None = None,
) -> dict[str, int]:
    cleaned = clean_all(lake.bronze.read_all(spark, tables), normalise_translation)
    return lake.silver.write_all(cleaned, stamp=PROCESSED_AT, version=version)


def stored_silver(spark: SparkSession, lake: Lake, tables: Sequence[str]) -> Mapping[str, DataFrame]:
    stored = lake.silver.read_all(spark, tables)
    return LazyTables({n: lambda n=n: stored[n].drop(*METADATA_COLUMNS) for n in tables})


def write_gold(
    spark: SparkSession,
    lake: Lake,
    tables: Sequence[str],
    layout: Layout | None = None,
    version: str | None = None,
    only: Sequence[str] = GOLD_TABLES,
) -> dict[str, int]:
    built = gold_from_silver(stored_silver(spark, lake, tables))
    wanted = {name: built[name] for name in only}
    return lake.gold.write_all(wanted, stamp=LOADED_AT, layout=layout, version=version)


def stored_gold(
    spark: SparkSession, lake: Lake, version: str | Mapping[str, str] | None = None
) -> Gold:
    """Gold of one snapshot, or of the versions named."""
    return gold_from_tables(lake.gold.read_all(spark, GOLD_TABLES, version))


# The numeric columns by which facts are read over several connections.
FACT_PARTITIONS = {"fact_order_items": "order_date_id", "fact_reviews": "review_date_id"}


def warehouse_gold(
    spark: SparkSession,
    target: JdbcTarget,
    bounds: Mapping[str, tuple[str, object, object]] | None = None,
) -> Gold:
    """The published tables read back over JDBC, for reports on the warehouse itself.

    ``bounds`` gives, for a table, a column with its lowest and highest value; the table is
    then read over parallel connections. The dated facts have theirs from the calendar.
    """
    known = dict(bounds or {})

    def read(name: str) -> DataFrame:
        if name in FACT_PARTITIONS and name not in known:
            days = target.read(spark, "dim_date").agg(F.min("date_id"), F.max("date_id")).first()
            if days[0] is not None:
                known[name] = (FACT_PARTITIONS[name], *days)
        return target.read(spark, name, *known.get(name, ()))

    return gold_from_tables(LazyTables({n: partial(read, n) for n in GOLD_TABLES}))


def publish_to_layer(target: Layer) -> Publisher:
    """Publish by copying the gold tables to another layer."""

    def publish(_: SparkSession, tables: dict[str, DataFrame], __: dict[str, int]) -> dict[str, int]:
        return target.write_all(tables)

    return publish


def publish_to_warehouse(target: JdbcTarget) -> Publisher:
    """Publish over JDBC, one table after another, each verified by its row count."""

    def publish(
        spark: SparkSession, tables: dict[str, DataFrame], rows: dict[str, int]
    ) -> dict[str, int]:
        return {name: target.load(spark, df, name, rows[name]) for name, df in tables.items()}

    return publish


def run(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    lake: Lake,
    publish: Publisher | None = None,
    gate_bronze: bool = True,
    gate_silver: bool = False,
    normalise_translation: bool = False,
    layout: Layout | None = None,
    ledger: Ledger | None = None,
    keep: int | None = None,
) -> dict[str, dict[str, int]]:
    """All stages; returns the rows written per stage and table.

    Text that does not read as its declared type and records whose number of fields is not
    that of their header stop the run before anything is cleaned; ``gate_bronze=False`` lets
    unreadable text become NULL and drops such records instead. A failed check raises before
    gold replaces the gold that is read and before anything is published; ``gate_silver``
    also stops before gold is built. ``layout`` maps gold tables to the columns they are laid
    out by, for example ``{"fact_order_items": ["order_date_id"]}``.

    Every stage replaces its tables, so a run can be repeated. With a ``ledger`` it goes on
    instead: tables whose inputs and settings are those of an earlier run are kept as that run
    made them (their rows are reported as they were then). ``keep`` retains so many snapshots
    of every layer afterwards.
    """
    tables = list(sources)
    version = new_version()
    written: dict[str, dict[str, int]] = {}

    def stage(name: str, layer: Layer, inputs: Mapping[str, str | None], write) -> dict[str, str]:
        """Make what is not current; the versions of all tables of the stage."""
        current = ledger.current(spark, name, layer, inputs) if ledger and layer.versioned else {}
        todo = [t for t in inputs if t not in current]
        rows = write(todo) if todo else {}
        if ledger:
            ledger.record(spark, name, version, inputs, rows)
        written[name] = {t: rows[t] if t in rows else current[t].rows for t in inputs}
        return {t: version if t in rows else current[t].version for t in inputs}

    def made_of(versions: Mapping[str, str], *names: str, **settings) -> str | None:
        return from_versions(versions, names, **settings) if ledger else None

    inputs = source_inputs(sources) if ledger else dict.fromkeys(tables)
    bronze = stage(
        "bronze", lake.bronze, inputs, lambda todo: write_bronze(lake, {t: sources[t] for t in todo}, version)
    )
    lake.bronze.commit(spark, bronze)
    if gate_bronze:
        results = bronze_type_results(lake.bronze.read_all(spark, tables))
        if results:
            enforce(union_results(results))

    inputs = {t: made_of(bronze, t, normalise=normalise_translation) for t in tables}
    silver = stage(
        "silver",
        lake.silver,
        inputs,
        lambda todo: write_silver(spark, lake, todo, normalise_translation, version),
    )
    lake.silver.commit(spark, silver)
    silver_results = silver_suite(stored_silver(spark, lake, tables))
    if gate_silver:
        enforce(silver_results)

    columns = {t: list((layout or {}).get(t, ())) for t in GOLD_TABLES}
    inputs = {t: made_of(silver, *GOLD_INPUTS[t], layout=columns[t]) for t in GOLD_TABLES}
    versions = stage(
        "gold", lake.gold, inputs, lambda todo: write_gold(spark, lake, tables, layout, version, todo)
    )
    gold = stored_gold(spark, lake, versions)
    gold_results = gold_suite(gold)
    enforce(gold_results if gate_silver else silver_results.unionByName(gold_results))
    lake.gold.commit(spark, versions)
    if publish:
        stored = lake.gold.read_all(spark, GOLD_TABLES)
        written["published"] = publish(spark, stored, written["gold"])
    if keep:
        for layer in (lake.bronze, lake.silver, lake.gold):
            layer.retain(spark, keep)
    return written
