"""Tables between the rounds of iterative operators, in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession, name: str) -> str:
    """A new place in the folder that all executors share."""
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_rounds"
    return f"{base}/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written and read back, so that loops keep a short lineage and a lost executor costs only its tasks."""
    spark = df.sparkSession
    path = folder(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._round_path = path
    return out


def drop(*frames: DataFrame | None) -> None:
    """Delete the tables of frames from ``kept`` that nothing reads any more."""
    for df in frames:
        path = getattr(df, "_round_path", None)
        if path:
            spark = df.sparkSession
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
