"""Session factory and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(app: str = "airwave", master: str | None = None,
                shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE, skew-join splitting and a UTC clock.

    On a cluster leave ``master`` unset so spark-submit decides, and size
    ``shuffle_partitions`` to the data (about 128-256 MB per partition).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """This application's part of the shared folder for intermediate tables, ``spark.checkpoint.dir``.

    ``finish`` deletes it.  Only a local session without that setting, as in
    tests, gets a scratch folder of its own, which goes when the process ends.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder before running on a cluster")
        configured = tempfile.mkdtemp(prefix="airwave-ckpt-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
        sc.setCheckpointDir(configured)
        configured = sc.getCheckpointDir()
    return f"{configured.rstrip('/')}/{sc.applicationId}"


def finish(spark: SparkSession) -> None:
    """Delete every intermediate table of this application; call it when the results are written."""
    _delete(spark, checkpoint_dir(spark))


def durable(df):
    """Write ``df`` into the shared folder and read it back: computed once, lineage cut.

    A lost executor costs a re-read of the written files.  ``release`` deletes
    them when nothing reads them any more; the rest goes with ``finish``.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.durable_path = path
    return out


def release(df) -> None:
    """Delete the files behind a ``durable`` table."""
    path = getattr(df, "durable_path", None)
    if path:
        _delete(df.sparkSession, path)


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
