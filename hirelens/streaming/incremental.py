"""Incremental loading: new page files are parsed and appended once, exactly as plans.load does in batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.html import parse_adverts
from ..plans.load import insert_new
from ..sources.pages import STEM


def stream_pages(spark: SparkSession, folder: str) -> DataFrame:
    files = spark.readStream.text(folder, wholetext=True)
    return files.select(F.regexp_extract("_metadata.file_path", STEM, 1).alias("jobid"), F.col("value").alias("html"))


def load_stream(spark: SparkSession, folder: str, table: str, checkpoint: str, as_of: str) -> StreamingQuery:
    """Takes the files there are and stops. A batch that is run again inserts nothing twice, as stored keys are left out."""

    def append(batch: DataFrame, _: int) -> None:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table)
        there = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
        stored = spark.read.parquet(table).select("jobid") if there else None
        parse_adverts(insert_new(batch, stored), as_of).write.mode("append").parquet(table)

    return stream_pages(spark, folder).writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
