"""Choices within groups. Each states its whole order, so that results do not depend on the partitioning.

Where one row of a group is wanted, max_by/min_by aggregates combine before the shuffle and never sort a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def best_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The row of each key that is greatest in order (a struct of ascending columns, nulls least); ties need a last column."""
    row = F.struct(*[F.col(c) for c in df.columns])
    return df.groupBy(*keys).agg(F.max_by(row, F.struct(*order)).alias("_r")).select("_r.*")


def first_wins(df: DataFrame, keys: Sequence[str], ordinal: str) -> DataFrame:
    """The row of each key with the least ordinal."""
    row = F.struct(*[F.col(c) for c in df.columns])
    return df.groupBy(*keys).agg(F.min_by(row, F.col(ordinal)).alias("_r")).select("_r.*")


def top_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """At most n rows of each key. Spark limits groups before the shuffle, so that no group is sorted whole."""
    ranked = df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_n") <= n).drop("_n")


def round_robin(df: DataFrame, group: str, order: Sequence[Column], n: int) -> DataFrame:
    """n rows, one of each group in turn, groups by name. No group can give more than n, so that ranks stop there."""
    ranked = df.withColumn("turn", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("turn") <= n)
    return ranked.orderBy("turn", F.col(group).asc_nulls_first(), *order).limit(n)


def quota_sample(df: DataFrame, direct: Column, group: str, order: Sequence[Column], n: int) -> DataFrame:
    """A fourth of n (one at least) from the rows that are not direct, the rest from those that are, short sides filled up
    from the other; each side in round robin."""
    kind = df.withColumn("_direct", F.coalesce(direct, F.lit(False)))
    have = {r["_direct"]: r["count"] for r in kind.groupBy("_direct").count().collect()}  # two rows
    contrast = min(have.get(False, 0), max(1, n // 4))
    chosen = min(have.get(True, 0), n - contrast)
    contrast = min(have.get(False, 0), n - chosen)
    sides = [round_robin(kind.where(F.col("_direct") == side), group, order, size).drop("turn") for side, size in ((True, chosen), (False, contrast))]
    return sides[0].unionByName(sides[1]).withColumnRenamed("_direct", "direct")


def stratified(df: DataFrame, strata: Sequence[tuple[str, Column]], order: Sequence[Column], key: str, n: int) -> DataFrame:
    """The first row of each stratum that no earlier stratum took, then the first of the rest, n in all. Each stratum can be
    served from the first len(strata) rows that fit it: they are found for all strata in one pass, and only those and n more
    are looked at on the driver."""
    names = [name for name, _ in strata]
    flags = df.select(key, F.struct(*order).alias("_o"), *[F.coalesce(c, F.lit(False)).alias(name) for name, c in strata])
    member = F.explode(F.filter(F.array(*[F.when(F.col(name), F.lit(i)) for i, name in enumerate(names)]), lambda i: i.isNotNull()))
    fit: dict[int, list] = {}
    for r in top_n(flags.select(key, "_o", member.alias("_s")), ["_s"], [F.col("_o"), F.col(key)], len(strata)).orderBy("_s", "_o", key).collect() if strata else []:  # at most len(strata) squared
        fit.setdefault(r["_s"], []).append(r[key])
    picked: list = []
    for i in range(len(names)):
        picked += [k for k in fit.get(i, []) if k not in picked][: 1 if len(picked) < n else 0]
    rest = flags.orderBy("_o", key).limit(n + len(picked)).collect()
    picked += [r[key] for r in rest if r[key] not in picked][: n - len(picked)]
    rank = df.sparkSession.createDataFrame([(k, i) for i, k in enumerate(picked)], f"{key} {dict(df.dtypes)[key]}, rank int")
    return df.join(F.broadcast(rank), key)  # at most n rows


def holdout(df: DataFrame, stratum: str, group: str, order: Sequence[Column], sizes: dict[str, int]) -> DataFrame:
    """For each stratum its number of rows, taken from its groups in turn; ValueError if a stratum has too few."""
    have = {r[stratum]: r["count"] for r in df.where(F.col(stratum).isin(*sizes)).groupBy(stratum).count().collect()}  # one row a stratum
    short = {s: have.get(s, 0) for s, n in sizes.items() if have.get(s, 0) < n}
    if short:
        raise ValueError(f"too few rows: {short}, wanted: {sizes}")
    wanted = F.create_map(*[F.lit(x) for pair in sizes.items() for x in pair])
    turn = df.where(F.col(stratum).isin(*sizes)).withColumn("turn", F.row_number().over(Window.partitionBy(stratum, group).orderBy(*order))).where(F.col("turn") <= wanted[F.col(stratum)])
    placed = turn.withColumn("place", F.row_number().over(Window.partitionBy(stratum).orderBy("turn", F.col(group).asc_nulls_first(), *order)))
    return placed.where(F.col("place") <= wanted[F.col(stratum)])


def least_used_first(df: DataFrame, direct: Column, group: str, key: str, n: int) -> DataFrame:
    """n rows: direct ones from the least used group each time, and at most two others (a fourth of n at most, one at least), one
    of each kind of them first."""
    contrasts = min(2, max(1, n // 4))
    kind = df.withColumn("_direct", F.coalesce(direct, F.lit(False)))
    chosen = round_robin(kind.where("_direct"), group, [F.asc(key)], max(0, n - contrasts)).drop("turn")
    others = kind.where("not _direct").orderBy(F.col(group).asc_nulls_first(), key).limit(contrasts)
    return chosen.withColumn("reason", F.lit("direct")).unionByName(others.withColumn("reason", F.lit("contrast"))).drop("_direct")


def ranked(df: DataFrame, order: Sequence[Column], bucket: Column, name: str = "rank") -> DataFrame:
    """Consecutive numbers in a total order, without sorting all rows in one task: rows are numbered within ranges of bucket, a
    number that grows along the order, and ranges start after all rows before them."""
    kept = df.withColumn("_b", bucket)
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = kept.groupBy("_b").agg(F.count("*").alias("_n")).withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))  # one row a range
    own = F.row_number().over(Window.partitionBy("_b").orderBy(*order))
    starts = starts.select(F.col("_b").alias("_of"), "_start")
    return kept.withColumn("_own", own).join(starts, F.col("_b").eqNullSafe(F.col("_of"))).withColumn(name, F.col("_start") + F.col("_own")).drop("_b", "_of", "_start", "_own")


def page_of(total: int, page: int, size: int) -> tuple[int, int]:
    """(page, offset): the page asked for, or the last one there is."""
    last = max(1, -(-total // size))
    page = min(max(1, page), last)
    return page, (page - 1) * size


def most_common(df: DataFrame, value: str, ordinal: str, n: int) -> DataFrame:
    """The n most frequent values with their counts; of equals the one seen first."""
    counts = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("n"), F.min(ordinal).alias("first"))
    return counts.orderBy(F.desc("n"), "first").limit(n).drop("first")
