"""Snapshots merged with new rows, in place of upserts: a new version is written, none is changed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], preserve: Sequence[str] = (), latest: Column | None = None) -> DataFrame:
    """old with the rows of new put in: columns of new win, except preserve, which keep what old has. Of several new rows of
    a key the greatest in latest counts (without it, any equal rows). Unlike a full join and a window, one aggregate does it."""
    columns = old.columns
    row = lambda df, side: df.select(*keys, F.lit(side).alias("_side"), F.struct(*[F.col(c) for c in columns]).alias("_row"), (latest if latest is not None else F.lit(0)).alias("_order"))
    both = row(old, 0).unionByName(row(new, 1))
    pick = lambda side: F.max_by(F.when(F.col("_side") == side, F.col("_row")), F.when(F.col("_side") == side, F.struct("_order")))
    merged = both.groupBy(*keys).agg(pick(0).alias("_old"), pick(1).alias("_new"))
    out = []
    for c in columns:
        if c in keys:
            out.append(F.col(c))
        elif c in preserve:
            out.append(F.when(F.col("_old").isNotNull(), F.col(f"_old.{c}")).otherwise(F.col(f"_new.{c}")).alias(c))
        else:
            out.append(F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(f"_old.{c}")).alias(c))
    return merged.select(*out)


def fold_history(events: DataFrame, key: str, order: Sequence[str], entry: Column, separator: str = ">") -> DataFrame:
    """(key, entries, history): the entries of a key in order, joined to one text."""
    kept = events.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*order, entry.alias("_entry")))).alias("_h"))
    return kept.select(key, F.size("_h").alias("entries"), F.array_join(F.transform("_h", lambda h: h["_entry"]), separator).alias("history"))


def first_seen(df: DataFrame, key: str, ordinal: str, label: str) -> DataFrame:
    """(key, first, labels): the first ordinal of a key and all labels under which it came."""
    return df.groupBy(key).agg(F.min(ordinal).alias("first"), F.array_join(F.array_sort(F.collect_set(label)), "+").alias("labels"))
