"""Session builder for applications. Library functions take a session and never make one."""

from collections.abc import Mapping, Sequence

from pyspark.sql import SparkSession

# Settings the plans rely on. Shuffle partitions are left to the deployment: adaptive
# execution coalesces them, so a cluster sets a high initial number (see the README).
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}
DELTA_CONF = {
    "spark.sql.extensions": "io.delta.sql.DeltaSparkSessionExtension",
    "spark.sql.catalog.spark_catalog": "org.apache.spark.sql.delta.catalog.DeltaCatalog",
}


def session_conf(
    delta: bool = False, jars: Sequence[str] = (), conf: Mapping[str, str] | None = None
) -> dict[str, str]:
    """Base settings, optionally with the Delta catalog and JDBC driver jars."""
    settings = dict(BASE_CONF)
    if delta:
        settings |= DELTA_CONF
    if jars:
        settings["spark.jars"] = ",".join(jars)
    return settings | dict(conf or {})


def build_session(
    app_name: str = "stratamart",
    master: str | None = None,
    delta: bool = False,
    jars: Sequence[str] = (),
    conf: Mapping[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in session_conf(delta, jars, conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
