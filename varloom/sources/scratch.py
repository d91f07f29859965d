"""The folder that a cluster's machines share, for what is written once and read again."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """What ``spark.checkpoint.dir`` names.  Where nothing is named a local session gets a temporary folder (tests); on a
    cluster, whose machines don't share one, that is an error."""
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    held = context._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get().rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    own = tempfile.mkdtemp(prefix="varloom-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    context.setCheckpointDir(f"file://{own}")
    return context._jsc.sc().getCheckpointDir().get().rstrip("/")


def new_folder(spark: SparkSession, tag: str) -> str:
    """A folder of the shared one that nothing else uses."""
    return f"{shared_folder(spark)}/{tag}-{uuid.uuid4().hex}"


def kept(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and cut from what it came from."""
    context = df.sparkSession.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def written(df: DataFrame, tag: str, compression: str | None = None) -> DataFrame:
    """The same as a Parquet table: who reads it again takes only the columns that it needs."""
    path = new_folder(df.sparkSession, tag)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)
