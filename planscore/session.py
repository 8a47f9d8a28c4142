"""Session helpers: the settings every plan in this package assumes."""

from __future__ import annotations

import functools
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that change results or plans. Everything else is left to the cluster's defaults.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Static size estimates use compressed file bytes; parquet expands several-fold in memory.
    # Without this, a pruned fact scan can look small enough to broadcast.
    "spark.sql.sources.fileCompressionFactor": "8.0",
}


def build_session(master: str = "local[*]", app: str = "planscore",
                  shuffle_partitions: int = 8) -> SparkSession:
    """Local session for tests and the benchmark. On a cluster, use the cluster's session and
    call :func:`ensure_conf` instead."""
    builder = (SparkSession.builder.master(master).appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               # Call-site capture for error messages costs several JVM round trips per Column
               # function on the driver; off for batch runs.
               .config("spark.python.sql.dataFrameDebugging.enabled", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for k, v in REQUIRED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_conf(spark)
    return spark


def ensure_conf(spark: SparkSession) -> SparkSession:
    """Apply :data:`REQUIRED_CONF` to settings the session has not chosen explicitly; a value the
    cluster or the caller set is left alone."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    return spark


@functools.cache
def _local_scratch() -> str:
    """One scratch folder per process, for local sessions that name no shared folder (tests)."""
    return tempfile.mkdtemp(prefix="planscore-ckpt-")


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for written intermediates: the cluster's ``spark.checkpoint.dir``.

    Only a single-JVM session (master ``local`` / ``local[n]``), whose executor threads share the
    driver's disk, may leave it unset; a scratch folder is then used and the session is left
    unchanged. On any other master a missing shared folder is an error, because files written to
    one machine's disk are not seen by the others."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d
    try:
        d, master = spark.sparkContext.getCheckpointDir(), spark.sparkContext.master
    except Exception:  # sessions without a SparkContext handle
        master = spark.conf.get("spark.master", "")
    if d:
        return d
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all "
                           f"executors share (master is {master!r})")
    return _local_scratch()


def default_parallelism(spark: SparkSession) -> int:
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:
        return int(spark.conf.get("spark.sql.shuffle.partitions"))


_written: dict[int, list[str]] = {}


def materialize(df, name: str):
    """Write ``df`` once as parquet under the shared checkpoint folder and read it back.

    For derived inputs used several times, and to cut lineage: the written table outlives lost
    executors. :func:`drop_materialized` removes what a session has written."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/planscore-tables/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    _written.setdefault(id(spark), []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_materialized(spark: SparkSession) -> int:
    """Delete the tables :func:`materialize` wrote for this session; DataFrames that read them
    are unusable afterwards. Returns the number of tables removed."""
    paths = _written.pop(id(spark), [])
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
    return len(paths)
