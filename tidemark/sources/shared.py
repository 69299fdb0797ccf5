"""Where jobs keep what has to outlive an executor."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    A local session without one gets a temporary folder; on a cluster that
    would be another folder on each machine, so there it is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
    return spark.sparkContext.getCheckpointDir()


def new_folder(spark: SparkSession, name: str) -> str:
    """An unused path below :func:`shared_dir`."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def read_if_there(spark: SparkSession, path: str, schema: T.StructType, format: str = "parquet") -> DataFrame:
    """The table at ``path``, or no rows if nothing was ever written there. Writes nothing."""
    try:
        return spark.read.schema(schema).format(format).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
