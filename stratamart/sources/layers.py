"""Layer storage: tables under a directory or in a catalog schema, always fully replaced."""

import tempfile
import threading
import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from stratamart.lazy import LazyTables

_ENTRY = "table_name string, version string"
_COMMITTING = threading.Lock()
#: Kept in every snapshot: the layer's own folder beside the tables.
SNAPSHOTS = "snapshots"


def new_version() -> str:
    return f"version-{uuid.uuid4()}"


@dataclass(frozen=True)
class Snapshot:
    """Which version of every table belongs together. Number 0 is a layer without tables."""

    number: int
    versions: Mapping[str, str]


@dataclass(frozen=True)
class Layer:
    """``location`` is a directory, or a catalog schema when ``catalog`` is set.

    In a directory of plain files (any format but Delta) every write goes to a new version of
    the table, a folder of its own. A snapshot names the version of every table, and appears
    as a whole with the one file it is written in, so readers who resolve their tables through
    one snapshot see tables of one publication, also while the next one is under way or if it
    fails. Snapshots are numbered by the folders that are there, not by a clock. One run at a
    time writes a layer. ``retain`` removes what no kept snapshot names. Delta and catalog
    tables replace themselves.
    """

    location: str
    fmt: str = "parquet"
    catalog: bool = False
    options: Mapping[str, str] = field(default_factory=dict)

    @property
    def versioned(self) -> bool:
        return not self.catalog and self.fmt != "delta"

    # --- snapshots -----------------------------------------------------------------------

    def _numbers(self, spark: SparkSession) -> list[int]:
        """Numbers of snapshots, newest first; the newest may be without its file."""
        names = children(spark, f"{self.location}/{SNAPSHOTS}")
        return sorted((int(n.partition("=")[2]) for n in names if n.startswith("number=")), reverse=True)

    def snapshots(self, spark: SparkSession, newest: int | None = None) -> list[Snapshot]:
        """Whole snapshots, newest first."""
        found = []
        for number in self._numbers(spark):
            if newest is not None and len(found) == newest:
                break
            rows = spark.read.schema(_ENTRY).json(f"{self.location}/{SNAPSHOTS}/number={number}").collect()
            if rows:
                found.append(Snapshot(number, {r.table_name: r.version for r in rows}))
        return found

    def snapshot(self, spark: SparkSession) -> Snapshot:
        return next(iter(self.snapshots(spark, 1)), Snapshot(0, {}))

    def commit(
        self, spark: SparkSession, tables: Sequence[str] | Mapping[str, str], version: str | None = None
    ) -> None:
        """Publish written versions of tables at once; other tables stay as they are.

        ``tables`` are names that share ``version``, or maps each to its own.
        """
        if not self.versioned:
            return
        new = dict(tables) if version is None else dict.fromkeys(tables, version)
        with _COMMITTING:
            versions = {**self.snapshot(spark).versions, **new}
            number = max(self._numbers(spark), default=0) + 1
            rows = spark.createDataFrame(sorted(versions.items()), _ENTRY).coalesce(1)
            rows.write.mode("error").json(f"{self.location}/{SNAPSHOTS}/number={number}")

    def versions(self, spark: SparkSession, table: str) -> list[str]:
        """Versions of a table that are stored, published or not."""
        return children(spark, f"{self.location}/{table}")

    def retain(self, spark: SparkSession, snapshots: int) -> dict[str, list[str]]:
        """Keep the newest snapshots and the versions they name; remove the rest.

        Records go first, so that none names a removed version. What no snapshot names, such
        as the remains of a failed run, goes too. Gives the versions removed per table.
        """
        if not self.versioned:
            return {}
        if snapshots < 1:
            raise ValueError("at least the current snapshot is kept")
        kept = self.snapshots(spark, snapshots)
        numbers = {s.number for s in kept}
        for number in self._numbers(spark):
            if number not in numbers:
                remove(spark, f"{self.location}/{SNAPSHOTS}/number={number}")
        named = {(table, version) for s in kept for table, version in s.versions.items()}
        removed = {}
        for table in children(spark, self.location):
            if table != SNAPSHOTS:
                old = [v for v in self.versions(spark, table) if (table, v) not in named]
                for version in old:
                    remove(spark, f"{self.location}/{table}/{version}")
                removed[table] = old
        return removed

    # --- tables --------------------------------------------------------------------------

    def read(self, spark: SparkSession, table: str, version: str | None = None) -> DataFrame:
        """The current version of a table, or a named one that need not be committed."""
        if self.catalog:
            return spark.table(f"{self.location}.{table}")
        path = f"{self.location}/{table}"
        if self.versioned:
            path += f"/{version or self._named(self.snapshot(spark), table)}"
        return spark.read.format(self.fmt).load(path)

    def _named(self, snapshot: Snapshot, table: str) -> str:
        if table not in snapshot.versions:
            raise ValueError(f"{self.location}: no published version of {table}")
        return snapshot.versions[table]

    def read_all(
        self,
        spark: SparkSession,
        tables: Sequence[str],
        version: str | Mapping[str, str] | None = None,
    ) -> LazyTables:
        """Tables of one snapshot: the current one, or the versions named."""
        if not self.versioned:
            return LazyTables({table: partial(self.read, spark, table) for table in tables})
        if isinstance(version, str):
            versions = dict.fromkeys(tables, version)
        elif version is not None:
            versions = dict(version)
        else:
            current = self.snapshot(spark)
            versions = {table: self._named(current, table) for table in tables}
        return LazyTables({t: partial(self.read, spark, t, versions[t]) for t in tables})

    def write(
        self,
        df: DataFrame,
        table: str,
        stamp: str | None = None,
        partition_by: Sequence[str] = (),
        version: str | None = None,
        buckets: tuple[int, Sequence[str]] | None = None,
    ) -> int:
        """Replace a table and its schema; return the number of rows written.

        With a ``version`` the rows are written under that name and wait for ``commit``.
        Parquet is compressed by zstd unless the layer's options say otherwise.

        ``stamp`` names a column that receives the load time. Rows are counted by the write
        itself, in its last stage, where a retried task is counted once. ``partition_by``
        lays the table out by those columns; rows are first rebalanced on them, which keeps
        files few and splits a partition value that holds much of the data. ``buckets``, a
        number and columns, lays a catalog table out in so many files by a hash of the columns;
        tables with equal buckets join on them without a shuffle. One bucket holds all rows of
        a key, so it is for keys without very frequent values.
        """
        if buckets and not self.catalog:
            raise ValueError("only catalog tables know their buckets")
        if stamp:
            df = df.withColumn(stamp, F.current_timestamp())
        if buckets:
            df = df.repartition(buckets[0], *buckets[1])  # a file per bucket
        elif partition_by:
            df = df.hint("rebalance", *[F.col(c) for c in partition_by])
        counted = Observation(f"{table}-{uuid.uuid4()}")
        df = df.observe(counted, F.count(F.lit(1)).alias("rows"))
        packed = {"compression": "zstd"} if self.fmt == "parquet" else {}
        writer = df.write.format(self.fmt).mode("overwrite").options(**{**packed, **self.options})
        if self.fmt == "delta":
            writer = writer.option("overwriteSchema", "true")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if buckets:
            writer = writer.bucketBy(buckets[0], *buckets[1]).sortBy(*buckets[1])
        if self.catalog:
            writer.saveAsTable(f"{self.location}.{table}")
        elif not self.versioned:
            writer.save(f"{self.location}/{table}")
        else:
            own = version or new_version()
            writer.save(f"{self.location}/{table}/{own}")
            if version is None:
                self.commit(df.sparkSession, [table], own)
        return observed(counted, "rows")

    def write_all(
        self,
        tables: Mapping[str, DataFrame],
        stamp: str | None = None,
        layout: Mapping[str, Sequence[str]] | None = None,
        at_once: int = 4,
        version: str | None = None,
        buckets: Mapping[str, tuple[int, Sequence[str]]] | None = None,
    ) -> dict[str, int]:
        """Write independent tables, a few at a time, so that small ones share the cluster.

        ``layout`` maps tables to the columns they are laid out by, ``buckets`` to theirs. The tables are published
        together when all are written, or wait for ``commit`` if a ``version`` is given.
        """
        columns = layout or {}
        own = version or new_version()
        with ThreadPoolExecutor(max_workers=at_once) as pool:
            jobs = {
                name: pool.submit(
                    self.write, df, name, stamp, columns.get(name, ()), own, (buckets or {}).get(name)
                )
                for name, df in tables.items()
            }
            rows = {name: job.result() for name, job in jobs.items()}
        if version is None and rows:
            spark = next(iter(tables.values())).sparkSession
            self.commit(spark, list(rows), own)
        return rows


def observed(observation: Observation, name: str) -> int:
    """A count observed in a plan that has run; the optimizer leaves out the observation of a
    relation that it knows to be empty."""
    try:
        return observation.get[name]
    except Py4JJavaError as error:
        if "assertion failed" not in str(error.java_exception):
            raise
        return 0


def row_counts(spark: SparkSession, counts: Mapping[str, int]) -> DataFrame:
    """Counts per table as a DataFrame (one row per table)."""
    return spark.createDataFrame(list(counts.items()), "table_name string, row_count long")


def scratch_directory(spark: SparkSession) -> str:
    """A new directory in the shared folder named by ``spark.checkpoint.dir``.

    Without that setting a machine-local folder is used in local mode only; on a cluster
    executors could not see it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{_scratch_prefix(spark)}{uuid.uuid4()}"
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="stratamart-")


def _scratch_prefix(spark: SparkSession) -> str:
    return f"stratamart-{spark.sparkContext.applicationId}-"


def remove_scratch(spark: SparkSession) -> int:
    """Remove this application's scratch directories; lazy results over them end with them."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    own = [n for n in children(spark, shared) if n.startswith(_scratch_prefix(spark))] if shared else []
    return sum(remove(spark, f"{shared.rstrip('/')}/{name}") for name in own)


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder in whichever storage its path names; none if it is not there."""
    files, target = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(target)) if files.exists(target) else []


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a folder in whichever storage its path names; says whether it was there."""
    files, target = _file_system(spark, path)
    return files.delete(target, True)
