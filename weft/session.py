"""SparkSession helper and shared-storage locations."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at any scale: AQE re-plans joins and coalesces
# shuffle partitions at runtime, splits skewed partitions, and the
# session time zone is pinned so timestamps compare across engines.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.ansi.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "weft", extra: dict | None = None) -> SparkSession:
    """Return the active session or build one with the defaults above.

    On a cluster the launcher owns master/memory; this only fills in SQL
    settings that are not already set.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in _DEFAULTS.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir``."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the configured checkpoint folder; a scratch one is set only where
    none is configured and the master is local (tests), else it is an error:
    executors on other machines could not read each other's files."""
    current = checkpoint_dir(spark)
    if current:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return current
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="weft-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return local


def scratch_root(spark: SparkSession) -> str:
    """The folder of this application's steps, below the shared checkpoint folder."""
    return os.path.join(ensure_checkpoint_dir(spark), "weft", "steps", spark.sparkContext.applicationId)


def materialize(df: DataFrame, name: str = "step") -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    It cuts the lineage, survives lost executors (unlike a local checkpoint),
    and computes the plan once where an eager checkpoint computes it twice.
    The copy stays until :func:`drop_scratch`."""
    path = os.path.join(scratch_root(df.sparkSession), f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession) -> None:
    """Delete all steps of this application; DataFrames that read them fail afterwards."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver tables: ``<sf_dir>/<name>.parquet``."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
