"""Session settings the package relies on, and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Event times are UTC; a repeated JSON key keeps its last value. The JVM does not compile
# methods above 8000 bytes, so generated code that large is better split than fused.
# Event lines shrink about tenfold in a shuffle, so the 64 MB that Spark aims at for a task
# become over half a gigabyte there, which the sort before a write by folder may have to spill.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that somebody else created."""
    for key, value in SESSION_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder path for intermediate tables, on storage every executor can reach.

    The cluster names that storage in ``spark.checkpoint.dir``, or the application by
    ``SparkContext.setCheckpointDir``. There is no other place that is sure to be shared.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        raise ValueError("spark.checkpoint.dir is not set; it names the shared scratch folder")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write an intermediate result and read it back; ``path`` is overwritten.

    A join with a written table is planned by its true size: broadcast below Spark's
    threshold, else sorted and merged, with the rows of a hot key split over tasks.
    """
    path = path or scratch_dir(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
