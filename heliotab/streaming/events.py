"""Streams of event files: windows, sessions, duplicates, and upkeep of means while events come in."""

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from heliotab.operators.store import shared_folder


def event_stream(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """The Parquet files that a pattern finds, as they come, with `ts` as an instant of the session's time zone; the schema is that of the files there."""
    stream = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def tumbling(events: DataFrame, width: str, late: str) -> DataFrame:
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def sliding(events: DataFrame, width: str, slide: str, late: str) -> DataFrame:
    return events.withWatermark("ts", late).groupBy(F.window("ts", width, slide), "event_type").agg(F.count("*").alias("n"))


def sessions(events: DataFrame, gap: str, late: str) -> DataFrame:
    return events.withWatermark("ts", late).groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n"))


def once_each(events: DataFrame, keys: list[str], late: str) -> DataFrame:
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys)


def finished(stream: DataFrame, mode: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """The result after all that is there has been read, from a Parquet table in the shared checkpoint folder; no row passes through the driver. In append mode each batch adds its rows, in complete mode each one replaces the table. In update mode each batch adds the rows that it changed, with its number, and the last one of each key counts; state behind the watermark can be forgotten."""
    spark = stream.sparkSession
    at = shared_folder(spark)
    schema = StructType([StructField(f.name, f.dataType) for f in stream.schema])
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{at}/state").trigger(availableNow=True)
    if mode == "append":
        writer.format("parquet").start(f"{at}/rows").awaitTermination()
        return spark.read.schema(schema).parquet(f"{at}/rows")
    batches = []

    def keep(rows: DataFrame, batch: int) -> None:
        if mode == "complete":
            rows.write.mode("overwrite").parquet(f"{at}/rows")
        else:
            rows.withColumn("_batch", F.lit(batch)).write.mode("append").parquet(f"{at}/rows")
        batches.append(batch)

    writer.foreachBatch(keep).start().awaitTermination()
    if not batches:
        return spark.createDataFrame([], schema)
    if mode == "complete":
        return spark.read.schema(schema).parquet(f"{at}/rows")
    rest = [f.name for f in schema if f.name not in keys]
    last = spark.read.parquet(f"{at}/rows").groupBy(*keys).agg(F.max_by(F.struct(*rest), "_batch").alias("_last"))
    return last.select(*keys, *[F.col("_last").getField(c).alias(c) for c in rest])
