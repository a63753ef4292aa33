"""Sinks: record files, frozen outputs, manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON object a line with sorted keys; nulls are kept."""
    df.select(*sorted(df.columns)).write.mode(mode).option("ignoreNullFields", False).json(path)


def content_hash(df: DataFrame) -> str:
    """A hash of a frame's rows whatever their order and partitioning: row hashes are added up, so that nothing is sorted."""
    row = F.xxhash64(*[F.to_json(F.struct(F.col(c).alias("v"))) for c in sorted(df.columns)])
    sums = df.select(row.cast("decimal(38,0)").alias("h"), F.pmod(row, F.lit(1_000_003)).alias("m"))
    got = sums.agg(F.count("*").alias("n"), F.sum("h").alias("a"), F.sum(F.col("m") * F.col("m")).alias("b")).first()
    return f"{got['n']}-{got['a'] or 0}-{got['b'] or 0}"


def write_frozen(df: DataFrame, path: str) -> bool:
    """Write once: True if written, False if the same rows are there; ValueError if others are."""
    spark = df.sparkSession
    if _exists(spark, path):
        if content_hash(spark.read.parquet(path)) != content_hash(df):
            raise ValueError(f"{path} holds other rows")
        return False
    df.write.parquet(path)
    return True


def write_or_clear(df: DataFrame, path: str) -> int:
    """Write a ledger of the rows there are, or remove that of an earlier run; the number of rows."""
    rows = df.count()
    if rows:
        df.write.mode("overwrite").parquet(path)
    elif _exists(df.sparkSession, path):
        hadoop = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(hadoop, True)
    return rows


def manifest(frames: dict[str, DataFrame], run_id: str) -> DataFrame:
    """(run_id, name, rows, hash): one row for each frame of a run."""
    spark = next(iter(frames.values())).sparkSession
    rows = [(run_id, name, df.count(), content_hash(df)) for name, df in sorted(frames.items())]
    return spark.createDataFrame(rows, "run_id string, name string, rows bigint, hash string")


def write_csv(df: DataFrame, path: str) -> None:
    """A report of bounded size as one file with a header."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def materialise(spark: SparkSession, source: str, target: str, sha256: str) -> bool:
    """Copy a file and check its hash: True if copied, False if the right one was there already; ValueError if the source has
    another hash. The copy appears under its name only when it is whole."""
    if _exists(spark, target) and _sha256(spark, target) == sha256:
        return False
    if _sha256(spark, source) != sha256:
        raise ValueError(f"{source} has another hash")
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    a, b, part = hadoop.Path(source), hadoop.Path(target), hadoop.Path(f"{target}.part")
    fs = b.getFileSystem(conf)
    hadoop.FileUtil.copy(a.getFileSystem(conf), a, fs, part, False, True, conf)
    fs.delete(b, False)
    fs.rename(part, b)
    return True


def _sha256(spark: SparkSession, path: str) -> str:
    return spark.read.format("binaryFile").load(path).select(F.sha2("content", 256)).first()[0]
