"""Session settings and shared storage used by the operators."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the operators rely on. Adaptive execution splits a join partition that one hot key
# has made too large; forcing the split keeps that true when a later step uses the same keys. Generated
# methods above 8000 bytes are never compiled by the JVM, which wide tables run into; below that limit
# Spark evaluates such a stage by smaller methods, several times faster. Arrow batches are held whole by Python
# workers, some of them twice, so they are kept small.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.session.timeZone": "UTC",
}


def tuned(spark: SparkSession) -> SparkSession:
    """Set a session up for this library: the runtime settings above stay set on it."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting, which has no other machine to share with, gets a folder made for
    it, which goes when the program ends.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        configured = context.getConf().get("spark.checkpoint.dir")
    current = context.getCheckpointDir()
    if configured is None and current is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        configured = tempfile.mkdtemp(prefix="tablewright-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    if current is None:
        context.setCheckpointDir(configured)
    return configured or current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str = "step") -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and go on from the written copy."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
