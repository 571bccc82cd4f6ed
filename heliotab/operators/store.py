"""Tables in the folder that all executors share, for results that several passes use."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder in spark.checkpoint.dir. Where none is set, a session in local mode (tests) uses a folder of this machine; on a cluster that is an error."""
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.getCheckpointDir():
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="heliotab-checkpoints-"))
    return f"{spark.conf.get('spark.checkpoint.dir', None) or spark.sparkContext.getCheckpointDir()}/heliotab/{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """The same rows from a new Parquet table in the shared folder, with the lineage cut."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
