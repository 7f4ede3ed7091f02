"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile

from pyspark.sql import SparkSession

# Settings the jobs rely on. AQE re-plans joins from runtime sizes and splits
# skewed shuffle partitions of equi-joins (a hot member or order key).
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "launchboard", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(RECOMMENDED_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_recommended_conf(spark: SparkSession) -> None:
    """Set the runtime SQL settings on an existing session; settings that the
    user gave, at start or since, keep their values."""
    given = {r["key"] for r in spark.sql("SET").collect()}
    for k, v in RECOMMENDED_CONF.items():
        if k not in given and k != "spark.sql.session.timeZone":
            spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder used to cut lineage.

    On a cluster this is the shared folder named by ``spark.checkpoint.dir``.
    Only when nothing is configured (local tests) a private temp folder is
    created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder")
        configured = tempfile.mkdtemp(prefix="launchboard-ckpt-", dir=os.environ.get("TMPDIR"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_root(spark: SparkSession) -> str:
    """Folder of the engine's written relations, under the shared root named by
    the cluster."""
    root = (spark.conf.get("spark.checkpoint.dir", None)
            or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
            or checkpoint_dir(spark))
    return f"{root.rstrip('/')}/launchboard"


_written: set[str] = set()


@atexit.register
def _drop_written() -> None:
    """Results of queries are read from what their runs have written, so it stays until
    the program ends."""
    spark = SparkSession.getActiveSession()
    with contextlib.suppress(Exception):  # the session may be gone
        for path in list(_written) if spark else ():
            _delete(spark, path)


def drop_at_exit(path: str) -> None:
    _written.add(path)


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    _written.discard(path)


def materialize(df, name: str, run_id: str):
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back: one computation, lineage cut, and the result survives executor loss.
    ``run_id`` keeps concurrent runs apart."""
    root = f"{scratch_root(df.sparkSession)}/{run_id}"
    drop_at_exit(root)
    path = f"{root}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def drop_run(spark: SparkSession, run_id: str) -> None:
    """Remove what a finished run has written."""
    _delete(spark, f"{scratch_root(spark)}/{run_id}")
