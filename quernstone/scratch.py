"""Tables written to the folder that the cluster shares, so that lost executors cost a reread and not a lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """The folder that the cluster shares, from spark.checkpoint.dir; a temporary one only on a local master whose session names none."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="quernstone-")
        spark.sparkContext.setCheckpointDir(f"file://{base}")
        base = spark.sparkContext.getCheckpointDir()
    return base.rstrip("/")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df once to the shared folder and read it back: a lost executor costs a reread, not the lineage."""
    path = f"{scratch_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables of materialise() that nothing reads any more. Frames derived from them must have been written."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._scratch)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
