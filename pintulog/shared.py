"""Shared storage for intermediate tables that must outlive an executor."""

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession

_made: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder below the one the cluster names in ``spark.checkpoint.dir``.

    A checkpoint folder set on the context counts too. There is no fallback: a folder
    only one machine sees would lose tables, so a session without a setting is refused.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    path = f"{base.rstrip('/')}/pintulog/{uuid.uuid4().hex}"
    _made.append(path)
    return path


def settle(df: DataFrame, folder: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet in shared storage and read it back.

    Cuts lineage: later plans that use the result more than once read the table
    instead of recomputing the log scan, and losing an executor costs a re-read.
    """
    spark = df.sparkSession
    path = folder or shared_folder(spark)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files of finished work now.

    It does so when the driver's garbage collector finds their plans unused, which on
    a driver with little to do may be long after; worth a call between large stages.
    """
    gc.collect()
    spark._jvm.System.gc()


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete these folders in whatever store holds them."""
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def release(spark: SparkSession) -> int:
    """Delete every folder made so far; for the caller, once no result that reads one is used."""
    paths, _made[:] = list(_made), []
    remove(spark, *paths)
    return len(paths)


def drop_settled(*tables: DataFrame) -> None:
    """Delete the folders that these settled tables read."""
    for table in tables:
        folders = {path.rpartition("/")[0] for path in table.inputFiles()}
        remove(table.sparkSession, *folders)
        _made[:] = [path for path in _made if not any(f.endswith(path.removeprefix("file:")) for f in folders)]
