"""Session helpers: build a session, pin the settings the semantics rely on,
and find the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Runtime SQL confs every query relies on (safe to set on a caller's session).
#  - UTC session zone: timestamps parse, format and window in UTC.
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
}

# Join and shuffle policy, also pinned per query:
#  - no broadcast from static estimates (parquet sizes are compressed bytes
#    and under-state a table several times); the planner uses shuffle joins
#    and AQE turns a join into a broadcast only when the measured map output
#    of a side is under the runtime threshold.  Tables with a fixed size
#    bound (nation, region, the campaign list) carry explicit broadcast hints.
#  - AQE coalesces small shuffle partitions and splits skewed join partitions.
PLAN_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# Settings for throughput; a cluster deployment sizes shuffle partitions itself.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.driver.memory": "8g",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(app: str = "ordermill", master: str | None = None,
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **SEMANTIC_CONF, **PLAN_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the confs the results and plans rely on (the caller may own the session)."""
    for k, v in {**SEMANTIC_CONF, **PLAN_CONF}.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the deployment (a shared file system).
    Only a local-mode session without one (tests) gets a fresh temp folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
    path = tempfile.mkdtemp(prefix="ordermill-ckpt-")
    sc.setCheckpointDir(path)
    return path
