"""SparkSession builder and shared-storage helpers.

Settings that change query semantics are pinned here: UTC session time zone
(NTZ -> epoch arithmetic has no DST gaps), ANSI mode on (so coercions must use
``try_*``), adaptive execution with skew-join splitting on.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "sparkgate", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine's semantic settings."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    b = b.config("spark.ui.enabled", "false")
    for k, v in _SEMANTIC_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    apply_semantics(spark)
    return spark


def apply_semantics(spark: SparkSession) -> None:
    """Pin the runtime settings the operators rely on (safe on a shared session)."""
    for k, v in _SEMANTIC_CONF.items():
        spark.conf.set(k, v)


def _plain_path(uri: str) -> str:
    """A folder's path without an empty authority or trailing slashes: ``file:///a/`` and
    ``file:/a`` are the same folder as ``/a`` is on the default file system."""
    scheme, colon, rest = uri.rpartition("file:")
    return "/" + rest.strip("/") if colon and not scheme else uri.rstrip("/")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Reads ``spark.checkpoint.dir`` from the session. Only a local-mode session (tests,
    single-machine runs) may fall back to a scratch folder of its own; on a cluster an
    unset setting is an error, since a machine-local folder is not shared.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        d = tempfile.mkdtemp(prefix="sparkgate-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    current = spark.sparkContext.getCheckpointDir() or ""
    # the context uses one subfolder of the folder it was given
    if _plain_path(os.path.dirname(current)) != _plain_path(d):
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for intermediate tables."""
    base = checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


def register_cleanup(spark: SparkSession, path: str) -> None:
    """Delete a written scratch table when the application's file system closes (JVM
    exit), so DataFrames read from it stay valid for the whole session."""
    try:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)
    except Exception:  # noqa: BLE001 - cleanup is best effort
        pass


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a Parquet table in the shared checkpoint folder and read it
    back: later passes (order statistics, counts, the main query) scan only the columns
    they need instead of recomputing the upstream shuffle, and the lineage is cut
    (survives executor loss)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    register_cleanup(spark, path)
    return spark.read.schema(df.schema).parquet(path)   # schema given: empty inputs read too
