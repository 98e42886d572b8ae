"""Helpers shared by the operators: shared-folder stages, typed null columns, word splitting."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from airwave.session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder of ``spark.checkpoint.dir`` and read it back.

    This cuts the lineage: a lost executor costs a re-read of the written
    files.  The folder is removed by ``drop_stage`` or with the checkpoint
    folder itself.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stage_path = path
    return out


def drop_stage(df: DataFrame) -> None:
    """Delete the files of a stage that nothing reads any more."""
    path = getattr(df, "stage_path", None)
    if path:
        jvm = df.sparkSession._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(target, True)


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """From now on rows go to Python in Arrow batches of at most 4 MB, where the session sets no limit of its own.

    A batch is held several times over (Spark's copy, the worker's, its texts as
    objects), and workers and heap keep what they once took.
    """
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, "4m")


def rows_of(df: DataFrame) -> DataFrame:
    """All columns packed into the struct column ``row``, so that none can clash with an operator's own."""
    return df.select(F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("row"))


def extended(df: DataFrame, fields: str) -> StructType:
    """The schema of ``df`` with more fields, given as a DDL string."""
    return StructType([*df.schema.fields, *StructType.fromDDL(fields).fields])


def binary_texts(column) -> list:
    """UTF-8 bytes of an Arrow string column (None stays None)."""
    return column.cast(pa.binary()).to_pylist()


def fmix(x: np.ndarray) -> np.ndarray:
    """Finalising mix of 64-bit values (in place on a fresh array)."""
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x
