"""Counts, shares and rollups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def percent(part: Column, whole: Column) -> Column:
    """Per cent with two decimals, 0.0 of nothing."""
    return F.coalesce(F.round(F.try_divide(100.0 * part, whole), 2), F.lit(0.0))


def coverage(df: DataFrame, fields: dict[str, Column]) -> DataFrame:
    """(field, present, total, percent) from one pass: all conditional counts are in one aggregate, then turned to rows."""
    counted = df.agg(F.count("*").alias("_total"), *[F.count_if(c).alias(name) for name, c in fields.items()])
    rows = F.array(*[F.struct(F.lit(n).alias("field"), F.col(n).alias("present")) for n in fields])
    return counted.select(F.explode(rows).alias("r"), F.col("_total").alias("total")).select("r.field", "r.present", "total", percent(F.col("r.present"), F.col("total")).alias("percent"))


def crosstab(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.groupBy(a, b).agg(F.count("*").alias("n"))


def pivot_counts(df: DataFrame, key: str, value: str, values: Sequence[str]) -> DataFrame:
    """One column of counts for each value; the list is given, so that no pass is spent to find it."""
    return df.groupBy(key).agg(*[F.count_if(F.col(value) == v).alias(v.lower()) for v in values])


def multivalue_counts(df: DataFrame, key: str, values: Column) -> DataFrame:
    """(value, n): in how many rows a value occurs, once for each row."""
    return df.select(F.explode(F.array_distinct(values)).alias("value")).where("value is not null").groupBy("value").agg(F.count("*").alias("n"))


def identifier_counts(df: DataFrame, ids: Sequence[Column]) -> DataFrame:
    """(identifiers, n): how many rows have 0, 1, 2 … of the identifiers."""
    have = sum((c.isNotNull().cast("int") for c in ids[1:]), ids[0].isNotNull().cast("int"))
    return df.groupBy(have.alias("identifiers")).agg(F.count("*").alias("n"))


def project_identity(df: DataFrame, key: str, kind: str, value: str, source: str) -> DataFrame:
    """(key, kind, state, value, candidates, distinct_values): accepted if a kind has one value, conflict if several; conflicting
    values are not decided, but stay visible in candidates, an array of struct(value, sources) in the order of values."""
    known = df.where(F.col(value).isNotNull()).groupBy(key, kind, value).agg(F.array_sort(F.collect_set(source)).alias("from"))
    return known.groupBy(key, kind).agg(
        F.count("*").alias("distinct_values"), F.min(value).alias("least"), F.array_sort(F.collect_list(F.struct(F.col(value).alias("value"), F.col("from").alias("sources")))).alias("candidates")
    ).select(key, kind, F.when(F.col("distinct_values") == 1, "accepted").otherwise("conflict").alias("state"), F.when(F.col("distinct_values") == 1, F.col("least")).alias("value"), "candidates", "distinct_values")


def classifier_metrics(df: DataFrame, predicted: str, reference: str) -> DataFrame:
    """Per label: tp, fp, fn, precision, recall, f1 (0 where undefined; precision and recall null there); labels are those of
    either side."""
    pairs = df.where(F.col(predicted).isNotNull() & F.col(reference).isNotNull()).groupBy(predicted, reference).agg(F.count("*").alias("n"))
    same = F.col(predicted) == F.col(reference)
    sides = F.array(F.struct(F.col(predicted).alias("label"), F.when(same, F.col("n")).otherwise(0).alias("tp"), F.when(same, 0).otherwise(F.col("n")).alias("fp"), F.lit(0).cast("bigint").alias("fn")),
                    F.struct(F.col(reference).alias("label"), F.lit(0).cast("bigint").alias("tp"), F.lit(0).cast("bigint").alias("fp"), F.when(same, 0).otherwise(F.col("n")).alias("fn")))
    counts = pairs.select(F.explode(sides).alias("s")).groupBy("s.label").agg(*[F.sum(f"s.{c}").alias(c) for c in ("tp", "fp", "fn")])
    rated = counts.withColumn("precision", F.round(F.try_divide("tp", F.col("tp") + F.col("fp")), 4)).withColumn("recall", F.round(F.try_divide("tp", F.col("tp") + F.col("fn")), 4))
    return rated.withColumn("f1", F.coalesce(F.round(F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")), 4), F.lit(0.0)))


def confusion_errors(df: DataFrame, predicted: str, reference: str) -> DataFrame:
    return df.where(F.col(predicted) != F.col(reference)).groupBy(predicted, reference).agg(F.count("*").alias("n"))


def map_rollup(df: DataFrame, key: str, category: str) -> DataFrame:
    """(key, total, by): counts by category as sorted text, from two levels of aggregation."""
    counts = df.groupBy(key, category).agg(F.count("*").alias("n"))
    cell = F.concat(F.coalesce(F.col(category), F.lit("-")), F.lit("="), F.col("n").cast("string"))
    return counts.groupBy(key).agg(F.sum("n").alias("total"), F.array_join(F.array_sort(F.collect_list(cell)), ";").alias("by"))


def classifier_summary(df: DataFrame, predicted: str, reference: str) -> DataFrame:
    """(rows, correct, accuracy, macro_f1) of the rows that have both; macro-F1 is the mean over the labels of either side."""
    both = df.where(F.col(predicted).isNotNull() & F.col(reference).isNotNull())
    counts = both.agg(F.count("*").alias("rows"), F.count_if(F.col(predicted) == F.col(reference)).alias("correct"))
    macro = classifier_metrics(df, predicted, reference).agg(F.round(F.avg("f1"), 4).alias("macro_f1"))
    return counts.join(F.broadcast(macro)).select("rows", "correct", F.round(F.try_divide("correct", "rows"), 4).alias("accuracy"), "macro_f1")  # one row each


def spread(df: DataFrame, key: str | None, value: Column, bands: Sequence[tuple[str, float]]) -> DataFrame:
    """Per key: rows, min, max, mean of a value and the number of rows in each band, a band being named by its least value."""
    order = sorted(bands, key=lambda b: -b[1])
    band = F.coalesce(*[F.when(value >= least, F.lit(name)) for name, least in order])
    grouped = df.groupBy(key) if key else df
    return grouped.agg(F.count("*").alias("rows"), F.min(value).alias("least"), F.max(value).alias("most"), F.round(F.avg(value), 4).alias("mean"), *[F.count_if(band == name).alias(f"in_{name}") for name, _ in order])


def batch_sizes(df: DataFrame, key: str, text: Column, most_tokens: int) -> DataFrame:
    """(key, requests, chars, tokens, most_chars, too_large): sizes of batches of texts, a token being four characters, and whether
    a batch is larger than allowed."""
    sizes = df.groupBy(key).agg(F.count("*").alias("requests"), F.sum(F.length(text)).alias("chars"), F.max(F.length(text)).alias("most_chars"))
    tokens = F.floor(F.coalesce("chars", F.lit(0)) / 4)
    return sizes.withColumn("tokens", tokens).withColumn("too_large", tokens > most_tokens)


def require_within(sizes: DataFrame) -> DataFrame:
    """The sizes; ValueError if a batch is too large."""
    over = sizes.where("too_large").first()
    if over is not None:
        raise ValueError(f"a batch has {over['tokens']} tokens: {over[0]}")
    return sizes


def reason_counts(df: DataFrame, reasons: Column) -> DataFrame:
    """(reason, n): in how many rows each reason holds; none is a row of its own."""
    each = F.when(F.size(reasons) > 0, F.array_distinct(reasons)).otherwise(F.array(F.lit("none")))
    return df.select(F.explode(each).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


def topics_of_names(names: Column, start: str, end: str, suffix: str = "") -> Column:
    """Topics that file names carry between a beginning and an end, words for hyphens, each once by its lower-case form."""
    slug = lambda n: F.regexp_extract(F.regexp_extract(n, r"([^/]*)$", 1), rf"^\Q{start}\E(.*?)\Q{end}\E", 1)
    label = lambda n: F.trim(F.regexp_replace(slug(n), "-+", " "))
    titled = F.transform(F.filter(F.transform(names, label), lambda t: t != ""), lambda t: F.initcap(F.concat(t, F.lit(suffix))))
    return F.array_distinct(titled)


def membership(df: DataFrame, key: str, sets: dict[str, DataFrame]) -> DataFrame:
    """(name, members, total, percent): how many different keys of a frame each of other frames has, from one shuffle by key."""
    flags = [df.select(key, F.lit(1).alias("_in"), *[F.lit(0).alias(n) for n in sets])]
    flags += [other.select(key, F.lit(0).alias("_in"), *[F.lit(int(n == name)).alias(n) for n in sets]) for name, other in sets.items()]
    union = flags[0]
    for f in flags[1:]:
        union = union.unionByName(f)
    keys = union.groupBy(key).agg(F.max("_in").alias("_in"), *[F.max(n).alias(n) for n in sets]).where("_in = 1 and " + key + " is not null")
    counted = keys.agg(F.count("*").alias("total"), *[F.sum(n).alias(n) for n in sets])
    rows = F.array(*[F.struct(F.lit(n).alias("name"), F.coalesce(n, F.lit(0)).alias("members")) for n in sets])
    return counted.select(F.explode(rows).alias("r"), "total").select("r.name", "r.members", "total", percent(F.col("r.members"), F.col("total")).alias("percent"))
