"""Tables written once in the folder that the whole cluster shares."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Used only where the session names no shared folder and runs on one machine.
LOCAL_CHECKPOINTS = "/tmp/checkpoints/termloom"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir.

    A local master without that setting gets a folder of its own; a cluster
    without it is an error, since a machine-local folder would lose rows.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the whole cluster shares")
    os.makedirs(LOCAL_CHECKPOINTS, exist_ok=True)
    return f"file://{LOCAL_CHECKPOINTS}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df once as Parquet in the shared folder and read it back.

    This cuts the lineage: a lost executor makes later stages read the files
    again instead of computing them anew.  The files go when the session ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/termloom-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables that materialise wrote and that no later step reads, before the session ends."""
    for df in tables:
        spark = df.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if not folder.rsplit("/", 1)[-1].startswith("termloom-"):
                raise ValueError(f"{folder} is no intermediate table")
            where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
