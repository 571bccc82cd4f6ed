"""What the operators on texts share: the checkpoint folder and passes over texts in small Arrow chunks."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType

#: Rows and bytes of text that a worker holds as Python objects at once.
CHUNK_ROWS, CHUNK_BYTES = 256, 4_000_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def with_checkpoint_dir(spark: SparkSession) -> None:
    """Keeps the cluster's spark.checkpoint.dir. Where none is set, a session in local mode (tests) uses a folder of this machine; on a cluster that is an error, since executors don't share such folders."""
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.getCheckpointDir():
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="heliotab-checkpoints-"))


def materialised(df: DataFrame) -> DataFrame:
    """The same rows, computed once and kept in the shared checkpoint folder, with the lineage cut."""
    with_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows from a new Parquet table in the shared checkpoint folder."""
    spark = df.sparkSession
    with_checkpoint_dir(spark)
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    path = f"{shared}/heliotab/{uuid.uuid4().hex}/{name.replace(' ', '_')}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut to at most CHUNK_ROWS rows and about CHUNK_BYTES in the column `text`; a longer text stands alone."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()
        start = total = 0
        for i, size in enumerate(sizes):
            if i > start and (i - start >= CHUNK_ROWS or total + size > CHUNK_BYTES):
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        if start < len(sizes):
            yield batch.slice(start)


def map_texts(df: DataFrame, setup: Callable[[], Callable], schema: str, *keep: str, extra: str | None = None) -> DataFrame:
    """Runs over the column `text`, chunk by chunk, and returns the columns in keep and those of the schema; a column in keep with the name of one of the latter is left out.

    setup() is called once a task and returns a function from a list of texts (None for null) to a list of columns, each as long as the texts. With a column named in extra, the function gets the list of its values too.
    """
    added = StructType.fromDDL(schema)
    names = [k for k in keep if k not in added.names]
    own = df.select(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(names)], "text", *([F.col(extra).alias("extra")] if extra else []))
    types = [to_arrow_type(f.dataType) for f in added]

    def run(batches):
        each = setup()
        for chunk in chunks(batches):
            made = each(*(chunk.column(c).to_pylist() for c in ("text", extra and "extra") if c))
            yield pa.RecordBatch.from_arrays([chunk.column(i) for i in range(len(names))] + [pa.array(c, type=t) for c, t in zip(made, types, strict=True)], names=[*names, *added.names])

    return own.mapInArrow(run, StructType([StructField(k, own.schema[f"k{i}"].dataType) for i, k in enumerate(names)] + list(added)))
