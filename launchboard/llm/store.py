"""Scratch tables in the shared checkpoint folder.

The root is ``spark.checkpoint.dir`` of the session; only a local session that
has none gets a private temporary folder. Every ``Scratch`` has a folder of its
own, so concurrent jobs never meet. A written table cuts lineage and survives
the loss of executors.
"""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession

from launchboard.plans.session import checkpoint_dir, drop_at_exit


_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
ARROW_BATCH_BYTES = str(4 << 20)


def shared_root(spark: SparkSession) -> str:
    root = (spark.conf.get("spark.checkpoint.dir", None)
            or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
            or checkpoint_dir(spark))
    return root.rstrip("/")


class Scratch:
    """A private folder for one operator run."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{shared_root(spark)}/llm/{name}-{uuid.uuid4().hex[:12]}"
        drop_at_exit(self.path)  # results are read from it until then

    def keep(self, df: DataFrame, name: str, packed: bool = False) -> DataFrame:
        """Write ``df`` once and return the written table. Arrow batches are kept
        small meanwhile: a task holds one in the JVM and one in Python. ``packed``: its
        bytes are compressed already and written as they are, as a codec needs buffers of
        the size of a page, which holds several large values, outside the JVM's heap."""
        path = f"{self.path}/{name}"
        before = self.spark.conf.get(_BATCH)
        self.spark.conf.set(_BATCH, ARROW_BATCH_BYTES)
        try:
            (df.write.option("compression", "uncompressed") if packed else df.write).parquet(path)
        finally:
            self.spark.conf.set(_BATCH, before)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str = "") -> None:
        """Delete one table, or the whole folder, when its results are used up."""
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}".rstrip("/"))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def release(self) -> None:
        """Let Spark delete shuffle files of finished steps: its cleaner acts when
        the driver has collected their handles."""
        gc.collect()
        self.spark._jvm.System.gc()
