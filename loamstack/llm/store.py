"""Intermediate tables in the folder that all executors share.

Operators cut lineage by writing a table and reading it back, so a lost executor
costs only the tasks that it ran.  The folder is the one the session names in
``spark.checkpoint.dir``; only where that is unset one is chosen here: a folder
under /tmp in local mode, and under the warehouse on a cluster.
"""

from __future__ import annotations

import atexit
import shutil
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Spark removes an execution's shuffle files when it has ended; the written table replaces them.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows come to Python workers in batches of so many bytes, as a worker holds a batch several times over.
BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "16m"


def shared_dir(spark: SparkSession) -> str:
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    context = spark.sparkContext
    if named:
        return f"{named.rstrip('/')}/loamstack-{context.applicationId}"
    if context.master.startswith("local") and not context.master.startswith("local-cluster"):
        own = f"/tmp/checkpoints/loamstack-{context.applicationId}"
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        return f"file://{own}"
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_loamstack/{context.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None, **options: str) -> DataFrame:
    """Write ``df`` to a new shared table and return a reader of it; ``options`` are the writer's."""
    spark = df.sparkSession
    path = new_path(spark, name)
    writer = df.write.options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    before = {key: spark.conf.get(key, None) for key in (CLEANUP, BATCH)}
    spark.conf.set(CLEANUP, "true")
    spark.conf.set(BATCH, BATCH_BYTES)
    try:
        writer.parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    out = spark.read.schema(df.schema).parquet(path)
    out._loam_path = path
    return out


def drop(df: DataFrame) -> None:
    """Delete the table of a frame from ``materialize`` once nothing reads it."""
    path = getattr(df, "_loam_path", None)
    if path:
        spark = df.sparkSession
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
