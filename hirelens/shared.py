"""Tables written to the folder that all executors share: they cut a plan and outlive lost executors."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []


def folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or a temporary folder of our own in local mode only."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            named = tempfile.mkdtemp(prefix="checkpoint-")
        sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def written(df: DataFrame) -> DataFrame:
    """df as a Parquet table of the shared folder."""
    spark = df.sparkSession
    path = f"{folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append((spark, path))
    out = spark.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def release(*tables: DataFrame) -> None:
    """Delete written tables that nothing reads any more."""
    for df in tables:
        _written.remove((df.sparkSession, df._written_at))
        _delete(df.sparkSession, df._written_at)


@atexit.register
def _remove_written() -> None:
    for spark, path in _written:
        try:
            _delete(spark, path)
        except Exception:  # the session has ended before the interpreter  # noqa: BLE001
            return
