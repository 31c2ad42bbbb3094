"""Warehouse over JDBC: overwrite sink for the gold tables, partitioned read for reports."""

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


class IncompleteLoadError(Exception):
    """The warehouse table does not hold the rows that were sent."""


@dataclass(frozen=True)
class JdbcTarget:
    """Connection and load settings; credentials are plain parameters of the caller.

    ``connections`` bounds the parallel connections, ``truncate`` keeps the table's own DDL
    instead of recreating it.
    """

    url: str
    user: str | None = None
    password: str | None = None
    driver: str | None = None
    connections: int = 16
    batch_size: int = 10_000
    truncate: bool = False
    options: Mapping[str, str] = field(default_factory=dict)

    def connection(self) -> dict[str, str]:
        settings = {"url": self.url, **self.options}
        for key in ("user", "password", "driver"):
            if getattr(self, key) is not None:
                settings[key] = getattr(self, key)
        return settings

    def write_options(self, table: str) -> dict[str, str]:
        return self.connection() | {
            "dbtable": table,
            "numPartitions": str(self.connections),
            "batchsize": str(self.batch_size),
            "truncate": str(self.truncate).lower(),
        }

    def write(self, df: DataFrame, table: str) -> None:
        df.write.format("jdbc").options(**self.write_options(table)).mode("overwrite").save()

    def read(
        self,
        spark: SparkSession,
        table: str,
        partition_column: str | None = None,
        lower: object = None,
        upper: object = None,
    ) -> DataFrame:
        """Read a table; with a column and its bounds, over parallel connections."""
        settings = self.connection() | {"dbtable": table}
        if partition_column is not None:
            settings |= {
                "partitionColumn": partition_column,
                "lowerBound": str(lower),
                "upperBound": str(upper),
                "numPartitions": str(self.connections),
            }
        return spark.read.format("jdbc").options(**settings).load()

    def count(self, spark: SparkSession, table: str) -> int:
        """Row count taken inside the database."""
        query = f"SELECT COUNT(*) AS row_count FROM {table}"
        counted = spark.read.format("jdbc").options(**self.connection(), query=query).load()
        return int(counted.first()[0])

    def load(self, spark: SparkSession, df: DataFrame, table: str, expected_rows: int) -> int:
        """Overwrite a table and verify it.

        Each task commits its own rows, so a task that is repeated after its commit (a lost
        executor) would add them twice. The count shows that; the caller repeats the
        overwrite.
        """
        self.write(df, table)
        loaded = self.count(spark, table)
        if loaded != expected_rows:
            raise IncompleteLoadError(f"{table}: {loaded} rows loaded, {expected_rows} expected")
        return loaded
