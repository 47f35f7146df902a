"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job relies on. Times are local clock values without a
# zone, so the session zone is pinned to UTC. Skewed join partitions are split at
# run time, even where the split costs one more exchange.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str, **options: str) -> SparkSession:
    """A session for the command line jobs; the cluster supplies master and sizes."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in options.items():
        builder = builder.config(key, value)
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("WARN")
    return spark


_local_scratch: str | None = None


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder that ``spark.checkpoint.dir`` names.

    Only where the setting is absent (tests, a single machine) a temporary local
    folder is used instead.
    """
    global _local_scratch
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
        if _local_scratch is None:
            _local_scratch = tempfile.mkdtemp(prefix="wayfact-")
        root = _local_scratch
    return f"{root.rstrip('/')}/wayfact/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage so that a result read several times is computed once, and a lost
    executor costs a re-read of files instead of a recomputation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
