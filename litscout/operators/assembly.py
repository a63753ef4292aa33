"""Records put together from several tables: details, overlays, retries, manifests."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_all(filters: dict[str, Sequence]) -> Column:
    """Every column has one of its values; a column without values is not asked about."""
    return reduce(lambda a, b: a & b, (F.col(c).isin(*values) for c, values in sorted(filters.items()) if values), F.lit(True))


def detail(parents: DataFrame, key: str, children: dict[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Parents with a list of structs for each kind of child, ordered by the columns named, which come first in the struct; empty
    where there are none. All children are gathered by one shuffle, side by side, and joined once."""
    parts = []
    for name, (df, order) in children.items():
        columns = [*order, *[c for c in df.columns if c != key and c not in order]]
        own = F.struct(*[F.col(c) for c in columns])
        parts.append(df.select(key, *[(own if n == name else F.lit(None)).alias(n) for n in children]))
    kinds = {name: parts[i].schema[name].dataType for i, name in enumerate(children)}
    typed = [p.select(key, *[F.col(n).cast(kinds[n]).alias(n) for n in children]) for p in parts]
    gathered = reduce(DataFrame.unionByName, typed).groupBy(key).agg(*[F.array_sort(F.collect_list(n)).alias(n) for n in children])
    return parents.join(gathered, key, "left").select(*parents.columns, *[F.coalesce(n, F.array().cast(gathered.schema[n].dataType)).alias(n) for n in children])


def overlay(row: dict[str, Column], payload: Column, later: Column) -> dict[str, Column]:
    """Columns with blanks filled from two maps, of which the later one wins."""
    merged = F.map_concat(F.map_filter(F.coalesce(payload, F.create_map().cast("map<string,string>")), lambda k, _: ~F.array_contains(F.map_keys(F.coalesce(later, F.create_map().cast("map<string,string>"))), k)), F.coalesce(later, F.create_map().cast("map<string,string>")))
    value = lambda name: F.nullif(F.trim(F.try_element_at(merged, F.lit(name))), F.lit(""))
    return {name: F.coalesce(F.nullif(F.trim(c.cast("string")), F.lit("")), value(name)).alias(name) for name, c in row.items()}


def overlay_identity(records: DataFrame, strong: DataFrame, key: str, second: str, fields: Sequence[str]) -> DataFrame:
    """Records whose fields come from strong, by key where it is there, else by the second key; what strong lacks stays."""
    by = lambda k: strong.where(F.col(k).isNotNull()).groupBy(k).agg(*[F.min(c).alias(f"_{k}_{c}") for c in fields])
    joined = records.join(by(key), key, "left").join(by(second), second, "left")
    return joined.select(*[F.coalesce(f"_{key}_{c}", f"_{second}_{c}", c).alias(c) if c in fields else F.col(c) for c in records.columns])


def match_outputs(outputs: DataFrame, manifest: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Outputs with their row of the manifest, and those that have none."""
    known = outputs.join(manifest.withColumn("_known", F.lit(True)), key, "left")
    return known.where("_known").drop("_known"), known.where("_known is null").select(*outputs.columns)


def retry_set(requests: DataFrame, failed: DataFrame, key: str) -> DataFrame:
    """Requests to send again: those of failed ids; ValueError if an id was never requested."""
    missing = failed.select(key).join(requests, key, "left_anti").first()
    if missing is not None:
        raise ValueError(f"{key} was never requested: {missing[0]}")
    return requests.join(failed.select(key), key, "left_semi")


def in_order(rows: DataFrame, manifest: DataFrame, key: str, position: str) -> DataFrame:
    """Rows of a manifest with their position in it; ValueError if one is missing or listed twice."""
    twice = manifest.groupBy(key).count().where("count > 1").first()
    missing = manifest.select(key).join(rows, key, "left_anti").first()
    if twice is not None or missing is not None:
        raise ValueError(f"{key}: {'listed twice' if twice is not None else 'missing'}: {(twice if twice is not None else missing)[0]}")
    return rows.join(manifest.select(key, position), key)


def with_decisions(candidates: DataFrame, decisions: DataFrame, key: str, same: Sequence[str], decision: str) -> DataFrame:
    """Candidates with their decision; ValueError if a decision was made on other values of the columns in same."""
    asked = decisions.select(key, decision, *[F.col(c).alias(f"_{c}") for c in same])
    joined = candidates.join(asked, key, "left")
    wrong = joined.where(F.col(decision).isNotNull() & ~reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in same), F.lit(True))).first()
    if wrong is not None:
        raise ValueError(f"the decision on {wrong[key]} is about other content")
    return joined.drop(*[f"_{c}" for c in same])


def changed_fields(before: dict[str, Column], after: dict[str, Column]) -> Column:
    """Names of the fields that are there afterwards and differ from before, in order."""
    return F.array_compact(F.array(*[F.when(after[n].isNotNull() & ~after[n].eqNullSafe(before[n]), F.lit(n)) for n in sorted(before)]))


def resolve(targets: DataFrame, resolved: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Targets with the resolved fields, what changed, and a status: unresolved, changed or unchanged."""
    found = resolved.select(key, F.lit(True).alias("_found"), *[F.col(f).alias(f"resolved_{f}") for f in fields])
    joined = targets.join(found, key, "left")
    changed = changed_fields({f: F.col(f) for f in fields}, {f: F.col(f"resolved_{f}") for f in fields})
    status = F.when(F.col("_found").isNull(), "unresolved").when(F.size(changed) > 0, "changed").otherwise("unchanged")
    return joined.withColumn("changed", changed).withColumn("status", status).drop("_found")


def to_repair(records: DataFrame, assessments: str, reasons: str, reason: str) -> DataFrame:
    """Records of which some assessment, an array of structs, failed for a reason."""
    return records.where(F.coalesce(F.exists(assessments, lambda a: F.array_contains(a[reasons], reason)), F.lit(False)))


def sources_union(frames: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Rows of several sources of one shape, with the ordinal and the name of their source, for choices that go by input order."""
    return reduce(DataFrame.unionByName, [df.withColumn("ordinal", F.lit(i)).withColumn("origin", F.lit(name)) for i, (name, df) in enumerate(frames)])


def snapshot(frames: dict[str, DataFrame]) -> DataFrame:
    """(name, rows) of tables, to be compared before and after a job that must not change them."""
    counted = [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("name"), "rows") for name, df in sorted(frames.items())]
    return reduce(DataFrame.unionByName, counted)


def require_same(before: DataFrame, after: DataFrame) -> None:
    """ValueError if two snapshots differ."""
    changed = before.exceptAll(after).unionByName(after.exceptAll(before)).orderBy("name").first()
    if changed is not None:
        raise ValueError(f"{changed['name']} was changed")


def worklist(reasons: Sequence[DataFrame], key: str) -> DataFrame:
    """(key, reasons): what is to be done again and why, from frames of (key, reason); reasons sorted, each once."""
    return reduce(DataFrame.unionByName, reasons).groupBy(key).agg(F.array_sort(F.collect_set("reason")).alias("reasons"))


def camel(df: DataFrame) -> DataFrame:
    """Columns named as interfaces of browsers name them."""
    name = lambda c: c.split("_")[0] + "".join(p.title() for p in c.split("_")[1:])
    return df.select(*[F.col(c).alias(name(c)) for c in df.columns])
