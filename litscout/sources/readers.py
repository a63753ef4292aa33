"""Sources: record files, tables, articles in XML, payloads of unknown format."""

from __future__ import annotations

import os
import unicodedata
from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from litscout.functions.text import visible_text


def read_jsonl(spark: SparkSession, path: str | list[str], schema: T.StructType | str, strict: bool = True) -> DataFrame:
    """One record a line with a given schema; nothing is inferred. Blank lines are skipped. strict: a broken line fails the
    job; otherwise it is dropped."""
    return spark.read.schema(schema).option("mode", "FAILFAST" if strict else "DROPMALFORMED").json(path)


def read_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Files with a header, all columns text, quotes doubled, values over several lines, and row_number from 2 on in each file. A
    file of this kind is read by one task from its start to its end, so that Spark's ascending ids keep its order; a file's
    numbers are their distance from its first one."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    rows = spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').option("encoding", "UTF-8").csv(path)
    numbered = rows.select("*", F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_id"))
    first = numbered.groupBy("_file").agg(F.min("_id").alias("_first"))  # one row a file
    return numbered.join(first, "_file").select(*columns, (F.col("_id") - F.col("_first") + 2).alias("row_number"))


def _folded(name: str) -> str:
    return "".join(ch for ch in unicodedata.normalize("NFKD", name) if not unicodedata.combining(ch)).casefold()


def resolve_file(folder: str, name: str) -> str:
    """The file of a folder whose name is the given one, accents and case aside; ValueError if several are."""
    found = [f for f in os.listdir(folder) if _folded(f) == _folded(name)]
    if len(found) > 1:
        raise ValueError(f"several files could be {name}: {sorted(found)}")
    if not found:
        raise FileNotFoundError(f"{folder}/{name}")
    return os.path.join(folder, found[0])


def latest(spark: SparkSession, pattern: str) -> str:
    """The last path of a pattern in lexical order, on any file system Spark reads."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    names = sorted(str(f.getPath()) for f in (found or []))
    if not names:
        raise FileNotFoundError(pattern)
    return names[-1]


def table_or_empty(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A Parquet table, or no rows of the schema where there is none."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def payload_format(text: Column) -> Column:
    """html, xml or unknown by the first characters."""
    head = F.lower(F.ltrim(F.substring(text, 1, 8000)))
    html = head.startswith("<!doctype html") | head.startswith("<html") | head.contains("<body")
    return F.when(html, "html").when(head.startswith("<?xml") | head.rlike(r"^<[a-z]"), "xml").otherwise("unknown")


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """(path, format, sha256, size, text) of whole files; markup is dropped from HTML and XML. PDF needs a parser that is not
    here: its text is null."""
    files = spark.read.format("binaryFile").load(path)
    raw = F.decode("content", "UTF-8")
    pdf = F.substring(raw, 1, 4) == "%PDF"
    kind = F.when(pdf, "pdf").otherwise(payload_format(raw))
    text = F.when(kind.isin("html", "xml"), visible_text(raw)).when(~pdf, raw)
    return files.select("path", kind.alias("format"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("size"), text.alias("text"))


_ARTICLE = (
    "struct<PMID:string,Article:struct<ArticleTitle:string,Journal:struct<Title:string,JournalIssue:struct<PubDate:struct<Year:string,Month:string,Day:string,MedlineDate:string>>>,Abstract:struct<AbstractText:array<string>>,"
    "Language:array<string>,PublicationTypeList:struct<PublicationType:array<string>>,AuthorList:struct<Author:array<struct<LastName:string,Initials:string,CollectiveName:string>>>>,"
    "MeshHeadingList:struct<MeshHeading:array<struct<DescriptorName:string>>>,ChemicalList:struct<Chemical:array<struct<NameOfSubstance:string>>>,KeywordList:struct<Keyword:array<string>>>"
)
_IDS = "struct<ArticleIdList:struct<ArticleId:array<struct<_IdType:string,_VALUE:string>>>>"


def read_articles(spark: SparkSession, path: str) -> DataFrame:
    """(pmid, doi, pmcid, title, journal, abstract, languages, publication_types, authors, mesh_terms, chemicals, keywords,
    publication_date) of PubmedArticle elements. Only an article's own id list is read, never those of the works it cites. The
    date has as many parts as are given; a date in words stands as it is."""
    schema = f"MedlineCitation {_ARTICLE}, PubmedData {_IDS}"
    rows = spark.read.format("xml").option("rowTag", "PubmedArticle").schema(schema).load(path)
    own = F.col("PubmedData.ArticleIdList.ArticleId")
    of = lambda kind: F.try_element_at(F.transform(F.filter(own, lambda i: i["_IdType"] == kind), lambda i: F.trim(i["_VALUE"])), F.lit(1))
    article = F.col("MedlineCitation.Article")
    date = article["Journal"]["JournalIssue"]["PubDate"]
    return rows.select(
        F.trim("MedlineCitation.PMID").alias("pmid"), F.lower(of("doi")).alias("doi"), F.upper(of("pmc")).alias("pmcid"), article["ArticleTitle"].alias("title"), article["Journal"]["Title"].alias("journal"),
        F.array_join(article["Abstract"]["AbstractText"], " ").alias("abstract"), article["Language"].alias("languages"), article["PublicationTypeList"]["PublicationType"].alias("publication_types"),
        F.transform(article["AuthorList"]["Author"], lambda a: F.coalesce(F.concat_ws(" ", F.nullif(a["LastName"], F.lit("")), a["Initials"]), a["CollectiveName"])).alias("authors"),
        F.col("MedlineCitation.MeshHeadingList.MeshHeading.DescriptorName").alias("mesh_terms"), F.col("MedlineCitation.ChemicalList.Chemical.NameOfSubstance").alias("chemicals"),
        F.col("MedlineCitation.KeywordList.Keyword").alias("keywords"),
        F.coalesce(F.nullif(F.concat_ws("-", date["Year"], date["Month"], date["Day"]), F.lit("")), date["MedlineDate"]).alias("publication_date"),
    )


def resolve_path(path: Column, root: str) -> Column:
    """Absolute paths and addresses as they are, others under root."""
    return F.when(path.rlike("^(?:/|[a-z][a-z0-9+.-]*://)"), path).otherwise(F.concat(F.lit(str(PurePosixPath(root)) + "/"), path))
