"""Building and publishing a search index from documents."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from litscout.functions.text import match_key


def search_text(parts: Sequence[Column]) -> Column:
    """Parts in lower case between blanks; empty ones are left out."""
    return F.lower(F.array_join(F.filter(F.array(*[F.coalesce(p, F.lit("")) for p in parts]), lambda p: F.trim(p) != ""), " "))


def facet_rows(documents: DataFrame, families: dict[str, Column], aliases: dict[str, Column] | None = None) -> DataFrame:
    """(family, value_key, document_id, display, is_canonical): one explode for all families, each cell of a row once. families
    gives arrays of values; aliases gives arrays of struct(alias, display), found by filters but not counted. Nothing is shuffled;
    rows repeated under one document_id give repeated cells, which counts of documents do not mind."""
    values = [_cells(c, family, lambda v: v, lambda v: v, True) for family, c in families.items()]
    values += [_cells(c, family, lambda v: v["alias"], lambda v: v["display"], False) for family, c in (aliases or {}).items()]
    kind = "array<struct<family:string,value_key:string,display:string,is_canonical:boolean>>"
    cells = F.array_distinct(F.concat(*[F.coalesce(v, F.array().cast(kind)) for v in values]))
    return documents.select("document_id", F.explode(F.filter(cells, lambda f: f["value_key"] != "")).alias("f")).select("f.family", "f.value_key", "document_id", "f.display", "f.is_canonical")


def _cells(values: Column, family: str, raw: Callable[[Column], Column], display: Callable[[Column], Column], canonical: bool) -> Column:
    return F.transform(values, lambda v: F.struct(F.lit(family).alias("family"), match_key(raw(v)).alias("value_key"), display(v).alias("display"), F.lit(canonical).alias("is_canonical")))


def gate(df: DataFrame, reasons: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows without any reason against them, and the others with theirs."""
    marked = df.withColumn("reasons", F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(name)) for name, c in reasons.items()])))
    return marked.where(F.size("reasons") == 0).drop("reasons"), marked.where(F.size("reasons") > 0)


def validate(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that keep all rules, and a row (violation) for each rule broken by the others."""
    good, bad = gate(df, {name: ~F.coalesce(c, F.lit(False)) for name, c in rules.items()})
    return good, bad.withColumn("violation", F.explode("reasons")).drop("reasons")


def publish(frames: dict[str, DataFrame], folder: str, partition: dict[str, list[str]] | None = None) -> str:
    """Write a new version beside the others, then point to it: readers see the old or the new index, never a mixture."""
    build = uuid.uuid4().hex
    for name, df in frames.items():
        df.write.partitionBy(*(partition or {}).get(name, [])).parquet(f"{folder}/versions/{build}/{name}")
    spark = next(iter(frames.values())).sparkSession
    pointer = json.dumps({"build": build, "frames": sorted(frames)})
    hadoop = spark._jvm.org.apache.hadoop.fs
    with_name, current_name = hadoop.Path(f"{folder}/.current-{build}"), hadoop.Path(f"{folder}/CURRENT")
    out = _files(spark, folder).create(with_name, True)
    out.write(bytearray(pointer.encode()))
    out.close()
    # One rename that replaces the pointer: there is no moment without one.
    options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    options[0] = getattr(hadoop, "Options$Rename").OVERWRITE
    hadoop.FileContext.getFileContext(current_name.toUri(), spark._jsc.hadoopConfiguration()).rename(with_name, current_name, options)
    return build


def current(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The frames of the published version."""
    held = json.loads(spark.read.text(f"{folder}/CURRENT", wholetext=True).first()[0])
    return {name: spark.read.parquet(f"{folder}/versions/{held['build']}/{name}") for name in held["frames"]}


def _files(spark: SparkSession, folder: str):
    return spark._jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
