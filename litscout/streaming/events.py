"""Streams of events: windows, sessions, duplicates, and merges of micro-batches. Every function takes a streaming frame or a
static one, after timed(); a watermark has no effect on the latter, so that both give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from litscout.operators.merge import upsert


def timed(df: DataFrame, late: str = "1 hour", column: str = "ts") -> DataFrame:
    """The frame with its watermark, which needs a timestamp with time zone; to be called once, before all else."""
    return df.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, late)


def tumbling(df: DataFrame, width: str = "1 hour") -> DataFrame:
    grouped = df.groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return grouped.select(F.col("window.start").alias("start"), "event_type", "n", "total")


def sessions(df: DataFrame, gap: str = "30 minutes") -> DataFrame:
    grouped = df.groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n"))
    return grouped.select("user_id", F.col("session_window.start").alias("start"), "n")


def without_repeats(df: DataFrame, keys: list[str]) -> DataFrame:
    if df.isStreaming:
        return df.dropDuplicatesWithinWatermark(keys)
    return df.dropDuplicates(keys)


def merge_into(path: str, keys: list[str], preserve: list[str], order: str, buckets: int = 64):
    """A foreachBatch function: each micro-batch is merged into the state at path. Keys are dealt to buckets by their hash, and only
    the buckets that a batch touches are read and written again, each under the batch's number; state() takes the last of each
    bucket. A batch that comes again after a failure merges with what was there before it and writes the same again."""

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        newest = batch.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in batch.columns]), F.col(order)).alias("_r")).select("_r.*")
        dealt = newest.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")).persist()
        touched = [r["bucket"] for r in dealt.select("bucket").distinct().collect()]  # at most as many as buckets
        held = _versions(spark, path, number - 1)
        old = [held[b] for b in touched if b in held]
        merged = dealt
        if old:
            merged = upsert(spark.read.schema(batch.schema).parquet(*old), newest, keys, preserve).withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
        merged.write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/{number}")
        dealt.unpersist()

    return merge


def state(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The merged rows at path: the last version of each bucket."""
    held = _versions(spark, path, None)
    return spark.read.schema(schema).parquet(*held.values()) if held else spark.createDataFrame([], schema)


def _versions(spark: SparkSession, path: str, upto: int | None) -> dict[int, str]:
    """bucket -> folder of its last version, up to a number."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/*/bucket=*")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    named = sorted((int(f.getPath().getParent().getName()), int(f.getPath().getName().split("=")[1]), f.getPath().toString()) for f in found)
    return {bucket: folder for number, bucket, folder in named if upto is None or number <= upto}
