"""Problem 5: records that differ only in how they are written.

Method: progressive partition refinement. A partition of the rows starts from an invariant of the column as it is, which is
cheap to compute and which no formatting difference changes: how often some groups of letters and digits occur, hashed to
eight bytes, so that only short keys are shuffled, after map-side combining. Rows alone in their class are done with. Only
the others' texts are stripped, and their exact keys refine the classes, as 128-bit hashes. The table is read for each of
the two sides of the refinement, which costs less than to shuffle the texts of all rows.

Defined results: a null key, or one without any letter or digit, is in no class. Rows repeated under one id count as
one copy of that id. An empty table gives an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from litscout.session import table

#: Groups of letters and digits of the histogram of titles.
LETTERS = ("ae", "io", "rl", "st", "nu", "cdm", "1234", "5678")
#: Of addresses: none of the letters and digits of a scheme, www. and a default port, which may be there or not.
ADDRESS = ("ae", "io", "nu", "rl", "cdm", *"125679")


def letters_and_digits(c: Column) -> Column:
    """Lower-case letters and digits of any script, in order."""
    return F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", "")


def invariants(c: Column, groups: Sequence[str]) -> Column:
    """How often each group of ASCII letters and digits occurs, as one 64-bit hash; case, order and all else are immaterial."""
    low = F.lower(c)
    return F.xxhash64(*[F.length(low) - F.length(F.translate(low, g, "")) for g in groups])


def plain_doi(c: Column) -> Column:
    """A DOI without blanks, letter case, surrounding punctuation and resolver prefix; null if nothing is left."""
    bare = F.regexp_replace(F.lower(c), r"(?U)\s+", "")
    bare = F.regexp_replace(bare, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")
    bare = F.regexp_replace(bare, r"^(?:(?:https?:)?/*[a-z0-9.-]*[a-z][a-z0-9.-]*/+|doi[:.]?/*)+(10\.)", "$1")
    return F.nullif(bare, F.lit(""))


def bare_url(c: Column) -> Column:
    """An address without blanks, case, surrounding punctuation, scheme, www. and default port."""
    bare = F.regexp_replace(F.lower(c), r"(?U)\s+", "")
    bare = F.regexp_replace(bare, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")
    bare = F.regexp_replace(bare, r"^(?:(http:/*[^/?#]*?):80|(https:/*[^/?#]*?):443)(?=[/?#]|$)", "$1$2")
    return F.regexp_replace(bare, r"^(?:https?:/*|//+)?(?:www\.)?", "")


def plain_url(bare: Column) -> Column:
    """The result of bare_url with surplus slashes dropped and parameters in one order."""
    path = F.regexp_replace(F.regexp_replace(F.regexp_extract(bare, r"^([^?]*)", 1), "/+", "/"), "/$", "")
    params = F.array_join(F.array_sort(F.filter(F.split(F.regexp_extract(bare, r"\?(.*)$", 1), "&"), lambda p: p != "")), "&")
    return F.concat(path, F.lit("?"), params)


def with_others(df: DataFrame, key: str) -> DataFrame:
    """The rows whose key is not theirs alone."""
    several = df.groupBy(key).count().where("count > 1").select(key)
    return df.join(several, key, "left_semi")


def refine(df: DataFrame, key: str, cheap: Column, exact: Sequence[Column]) -> DataFrame:
    """Classes of rows whose exact keys agree: (class_id, key), several ids or one, for rows that cheaper keys left with others.

    cheap must agree for rows whose exact keys agree; rows where it is null belong to no class, nor do those where the first
    exact key is null. Null and null agree in the others. class_id is a 128-bit hash of the exact keys.
    """
    columns = [c for c in df.columns if c != key]
    rows = df.select(F.col(key).alias("key"), *columns).where("key is not null").withColumn("_cheap", cheap).where("_cheap is not null")
    parts = [F.coalesce(F.concat(F.lit("="), c), F.lit("null")) for c in exact]
    whole = F.when(exact[0].isNotNull(), F.concat_ws("\u0001", *parts))
    return with_others(rows, "_cheap").select(F.md5(whole).alias("class_id"), "key").where("class_id is not null").distinct()


def pairs(members: DataFrame) -> DataFrame:
    """(key_a, key_b) for each two members of a class, key_a < key_b: the form the task fixes for copies."""
    a, b = members.withColumnRenamed("key", "key_a"), members.withColumnRenamed("key", "key_b")
    return a.join(b, "class_id").where("key_a < key_b").select("key_a", "key_b")


def representatives(classes: DataFrame) -> DataFrame:
    """(representative, copies): one record for each class of several ids, by its smallest id."""
    return classes.groupBy("class_id").agg(F.min("key").alias("representative"), F.count("*").alias("copies")).where("copies > 1").drop("class_id")


def publications(spark: SparkSession, sf: str) -> DataFrame:
    title = F.col("normalized_title")
    stripped = F.nullif(letters_and_digits(title), F.lit(""))
    return refine(table(spark, sf, "publication").select("document_id", "normalized_title"), "document_id", F.when(title.isNotNull(), invariants(title, LETTERS)), [stripped])


def documents(spark: SparkSession, sf: str) -> DataFrame:
    url = F.col("canonical_url")
    bare = F.nullif(bare_url(url), F.lit(""))
    df = table(spark, sf, "documents").select("document_id", "canonical_url", "doi")
    return refine(df, "document_id", F.when(url.isNotNull(), invariants(url, ADDRESS)), [plain_url(bare), plain_doi(F.col("doi"))])


def _both(spark: SparkSession, sf: str, form) -> DataFrame:
    named = [form(classes(spark, sf)).withColumn("table_name", F.lit(name)) for name, classes in (("publication", publications), ("documents", documents))]
    return named[0].unionByName(named[1])


def found(spark: SparkSession, sf: str) -> DataFrame:
    return _both(spark, sf, pairs).select("table_name", "key_a", "key_b")


def copies(spark: SparkSession, sf: str) -> DataFrame:
    return _both(spark, sf, representatives).select("table_name", "representative", "copies")


_KEYS = r"""
with pub as (
  select document_id, regexp_replace(lower(normalized_title), '[^\p{L}\p{N}]+', '', 'g') as k from publication where normalized_title is not null),
d0 as (
  select document_id,
    regexp_replace(regexp_replace(lower(doi), '\s+', '', 'g'), '^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$', '', 'g') as d,
    regexp_replace(regexp_replace(lower(canonical_url), '\s+', '', 'g'), '^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$', '', 'g') as u
  from documents),
d1 as (
  select document_id, nullif(regexp_replace(d, '^((https?:)?/*[a-z0-9.-]*[a-z][a-z0-9.-]*/+|doi[:.]?/*)+(10\.)', '\3'), '') as d,
    regexp_replace(regexp_replace(regexp_replace(u, '^(http:/*[^/?#]*):80([/?#]|$)', '\1\2'), '^(https:/*[^/?#]*):443([/?#]|$)', '\1\2'), '^(https?:/*|//+)?(www\.)?', '') as u
  from d0),
d2 as (
  select document_id, d, regexp_replace(regexp_replace(split_part(u, '?', 1), '/+', '/', 'g'), '/$', '') as path,
    array_to_string(list_sort([x for x in string_split(regexp_extract(u, '\?(.*)$', 1), '&') if x <> '']), '&') as params, u
  from d1 where u is not null and u <> ''),
members as (
  select distinct 'publication' as table_name, document_id, k from pub where k <> ''
  union all
  select distinct 'documents', document_id, coalesce('=' || d, 'null') || chr(1) || path || '?' || params from d2)
"""

QUERIES = {"p5_found": found, "p5_copies": copies}
ORACLES = {
    "p5_found": _KEYS + "select a.table_name, a.document_id as key_a, b.document_id as key_b from members a join members b on a.table_name = b.table_name and a.k = b.k and a.document_id < b.document_id",
    "p5_copies": _KEYS + "select table_name, min(document_id) as representative, count(*) as copies from members group by table_name, k having count(*) > 1",
}
