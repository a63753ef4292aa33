"""Session settings, table access and lineage cuts shared by all operators."""

from __future__ import annotations

import os
import re
import sys
import tempfile

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

#: Defaults that suit both a laptop and a cluster; everything else is left to the caller.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def session(master: str = "local[8]", **extra: str) -> SparkSession:
    """A session for tests, the bench and the command line; a cluster brings its own."""
    builder = SparkSession.builder.master(master).appName("litscout")
    for key, value in {**SETTINGS, "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship_package() -> None:
    """Send this package's Python functions by value, so that executors need no copy of it on their path."""
    cloudpickle.register_pickle_by_value(sys.modules["litscout"])


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """One Parquet table of a data directory."""
    return spark.read.parquet(f"{directory}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Only where it is unset and all executors are in this process, as in tests, one of
    our own is made and set; elsewhere that is an error, since executors cannot share a folder of this machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not folder:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        if not current.isDefined() and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = current.get() if current.isDefined() else tempfile.mkdtemp(prefix="litscout-")
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Compute a DataFrame once and cut its lineage, in the folder all executors share."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def spread(df: DataFrame) -> DataFrame:
    """A frame for work that costs far more than its input: one of fewer partitions than cores is dealt out to all of them."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def fixed_size(df: DataFrame, limit: int, what: str) -> list:
    """Collect a table whose size is bounded by contract; more than limit rows is an error, never a cut."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{what} has more than {limit} rows; it is read to the driver and must stay small")
    return rows


def default_directory() -> str:
    return os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
