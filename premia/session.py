"""Session factory. Operators never create a session; jobs and tests call this once."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Sizes are left to AQE: it coalesces small shuffle partitions and splits skewed ones at run time.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more exchange above the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    "spark.sql.session.timeZone": "UTC",
    # Plans here are built from many small expressions; recording a call site for each doubles that time.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


#: Partitions of a shuffle before AQE coalesces them, on a cluster. Reducers cannot be split in two when there are too few of them.
WIDE = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": "4000"}


def settings_for(master: str | None, extra: dict[str, str] | None = None) -> dict[str, str]:
    """The session's settings: a wide initial number of shuffle partitions unless all runs on this machine or ``extra`` gives a number."""
    extra = extra or {}
    local = master is not None and master.startswith("local")
    given = {"spark.sql.shuffle.partitions", *WIDE} & set(extra)
    return DEFAULTS | ({} if local or given else WIDE) | extra


def get_session(
    app_name: str = "premia",
    master: str | None = None,
    delta: bool = False,
    hive: bool = False,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build or get a session. ``delta`` needs the Delta jars on the class path already."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    tables = {
        "spark.sql.extensions": "io.delta.sql.DeltaSparkSessionExtension",
        "spark.sql.catalog.spark_catalog": "org.apache.spark.sql.delta.catalog.DeltaCatalog",
    }
    settings = settings_for(master, (tables if delta else {}) | (extra or {}))
    for key, value in settings.items():
        builder = builder.config(key, value)
    if hive:
        builder = builder.enableHiveSupport()
    return builder.getOrCreate()


def stop_session(spark: SparkSession | None) -> None:
    if spark is not None:
        spark.stop()
