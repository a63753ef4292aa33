"""Faceted term search over an index: requests, predicates, pages, facet counts, match kinds, previews.

An index is two frames: documents (document_id, search_text, publication_year, …) and facets (family, value_key,
document_id, display, is_canonical). Filters are semi joins against facets, so that Catalyst chooses how to run them.
"""

from __future__ import annotations

import base64
import json
import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from litscout.functions.text import clip, match_key, plain_match_key

#: Words without meaning for a search (fixed values).
STOP_WORDS = frozenset("a an and are as at for in is of on or the to with".split())
MOST_VALUES, MOST_ROWS, MOST_FACETS = 50, 50, 100
FIRST_YEAR, LAST_YEAR = 1500, 2100


@dataclass(frozen=True)
class Filter:
    """Keys of one facet family; any of them, or all."""

    values: tuple[str, ...]
    all_of: bool = False

    def keys(self) -> list[str]:
        """The different match keys of the values, without empty ones."""
        return sorted({k for v in self.values if (k := plain_match_key(v))})


@dataclass(frozen=True)
class Request:
    """A search. Blanks around the query are dropped; years are from 1500 to 2100; has_uncertainty filters a boolean column."""

    query: str = ""
    filters: dict[str, Filter] = field(default_factory=dict)
    year_from: int | None = None
    year_to: int | None = None
    has_uncertainty: bool | None = None
    limit: int = 10
    cursor: str | None = None

    def __post_init__(self) -> None:
        if not 1 <= self.limit <= MOST_ROWS:
            raise ValueError(f"limit must be from 1 to {MOST_ROWS}")
        object.__setattr__(self, "query", self.query.strip())
        for year in (self.year_from, self.year_to):
            if year is not None and not FIRST_YEAR <= year <= LAST_YEAR:
                raise ValueError(f"years are from {FIRST_YEAR} to {LAST_YEAR}")
        if self.year_from is not None and self.year_to is not None and self.year_from > self.year_to:
            raise ValueError("year_from is after year_to")
        for family, chosen in self.filters.items():
            if len(chosen.values) > MOST_VALUES:
                raise ValueError(f"more than {MOST_VALUES} values for {family}")


def terms(query: str) -> list[str]:
    """Words and hyphenated words of two characters or more that are no stop words, lower case, each once."""
    found = (w for w in re.findall(r"[\w-]+", query.casefold()) if len(w) > 1 and w not in STOP_WORDS)
    return list(dict.fromkeys(found))


def matches(text: Column, words: list[str]) -> Column:
    """Every word occurs; no words: everything matches. An underscore in a word stands for any character, as in LIKE."""
    return reduce(lambda a, b: a & b, (text.like(f"%{w}%") for w in words), F.lit(True))


def with_facets(documents: DataFrame, facets: DataFrame, filters: dict[str, Filter]) -> DataFrame:
    """Documents that pass all filters. Values are compared by their match keys, so that case, accents and a trailing
    abbreviation do not matter; a filter without values that have a key is not applied."""
    for family, chosen in sorted(filters.items()):
        keys = chosen.keys()
        if not keys:
            continue
        hits = facets.where((F.col("family") == family) & F.col("value_key").isin(keys)).select("document_id", "value_key")
        if chosen.all_of and len(keys) > 1:
            hits = hits.groupBy("document_id").agg(F.countDistinct("value_key").alias("n")).where(F.col("n") == len(keys))
        documents = documents.join(hits.select("document_id"), "document_id", "left_semi")
    return documents


def select(documents: DataFrame, facets: DataFrame, request: Request) -> DataFrame:
    """All documents of a request, in no order."""
    rows = documents.where(matches(F.col("search_text"), terms(request.query)))
    if request.year_from is not None:
        rows = rows.where(F.col("publication_year") >= request.year_from)
    if request.year_to is not None:
        rows = rows.where(F.col("publication_year") <= request.year_to)
    if request.has_uncertainty is not None:
        rows = rows.where(F.col("has_uncertainty") == request.has_uncertainty)
    return with_facets(rows, facets, request.filters)


def encode_cursor(offset: int, build: str) -> str:
    return base64.urlsafe_b64encode(json.dumps({"v": 1, "offset": offset, "build": build}).encode()).decode().rstrip("=")


def decode_cursor(cursor: str | None, build: str) -> int:
    """The offset of a cursor; ValueError if it is broken or of another build."""
    if cursor is None:
        return 0
    try:
        held = json.loads(base64.urlsafe_b64decode(cursor + "=" * (-len(cursor) % 4)))
        offset, of = int(held["offset"]), held["build"]
    except (ValueError, KeyError, TypeError) as e:
        raise ValueError("the cursor can't be read") from e
    if of != build or offset < 0:
        raise ValueError("the cursor belongs to another index")
    return offset


def page(rows: DataFrame, order: list[Column], limit: int, offset: int = 0) -> DataFrame:
    """A page of a total order; Spark keeps the first offset + limit rows of each task only."""
    return rows.orderBy(*order).offset(offset).limit(limit)


def search(documents: DataFrame, facets: DataFrame, request: Request, build: str = "") -> tuple[DataFrame, dict]:
    """A page and its envelope: total, offset, next cursor, terms, filters asked for and applied."""
    rows = select(documents, facets, request)
    offset, total = decode_cursor(request.cursor, build), rows.count()
    score = [F.desc_nulls_last("score")] if "score" in rows.columns else []
    order = [*score, F.desc_nulls_last("publication_year"), F.asc("document_id")]
    following = offset + request.limit
    trace = search_trace(request)
    return page(rows, order, request.limit, offset), {"total": total, "offset": offset, "next": encode_cursor(following, build) if following < total else None, **trace}


def search_trace(request: Request) -> dict:
    """The terms searched for, and the filters asked for and applied with their values."""
    others = {n: v for n, v in (("publication_year_from", request.year_from), ("publication_year_to", request.year_to), ("has_uncertainty", request.has_uncertainty)) if v is not None}
    shown = lambda c: {"values": list(c.values), "match": "all" if c.all_of else "any"}
    asked = {f: shown(c) for f, c in sorted(request.filters.items())}
    return {"terms": terms(request.query), "asked": asked | others, "applied": {f: v for f, v in asked.items() if request.filters[f].keys()} | others}


def facet_counts(documents: DataFrame, facets: DataFrame, top: int) -> DataFrame:
    """(family, value_key, display, documents, place): the most frequent canonical values of each family in a selection."""
    if not 1 <= top <= MOST_FACETS:
        raise ValueError(f"top must be from 1 to {MOST_FACETS}")
    inside = facets.where("is_canonical").join(documents.select("document_id"), "document_id", "left_semi")
    counts = inside.groupBy("family", "value_key").agg(F.min("display").alias("display"), F.countDistinct("document_id").alias("documents"))
    order = Window.partitionBy("family").orderBy(F.desc("documents"), "display", "value_key")
    return counts.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top)


def match_reasons(fields: dict[str, Column], request: Request) -> Column:
    """array<struct(criterion, criterion_type, field, value)>: for each query term the first of the fields (arrays of values)
    that holds it and the first such value; for each value of a filter the value of the field of its family with the same
    match key; for year and uncertainty filters the document's own value, from the fields publication_year and has_uncertainty."""
    kind = "array<struct<criterion:string,criterion_type:string,field:string,value:string>>"
    reason = lambda criterion, of, name, value: F.when(value.isNotNull(), F.struct(F.lit(criterion).alias("criterion"), F.lit(of).alias("criterion_type"), F.lit(name).alias("field"), value.alias("value")))
    first = lambda values, test: F.try_element_at(F.filter(values, test), F.lit(1))
    out = []
    for word in terms(request.query):
        out.append(F.coalesce(*[reason(word, "query_term", name, first(values, lambda v: F.lower(v).contains(word))) for name, values in fields.items()]))
    for family, chosen in request.filters.items():
        for value in chosen.values:
            key = plain_match_key(value)
            # Of several values with one key the last one is shown.
            same = F.filter(fields[family], lambda v: match_key(v) == key) if key else F.array().cast("array<string>")
            out.append(reason(f"{family}:{value}", "filter", family, F.try_element_at(same, F.lit(-1))))
    for name, field, value in (("publication_year_from", "publication_year", request.year_from), ("publication_year_to", "publication_year", request.year_to), ("has_uncertainty", "has_uncertainty", request.has_uncertainty)):
        if value is not None:
            out.append(reason(f"{name}:{str(value).lower()}", "filter", field, F.try_element_at(fields[field], F.lit(1))))
    return F.array_compact(F.array(*out)).cast(kind) if out else F.array().cast(kind)


def match_kind(reasons: Column, core: set[str], words: list[str]) -> Column:
    """direct or tangential, from match_reasons. With query terms: direct if each has a reason and all those are in core fields;
    without: direct if any filter's reason is in a core field, or if nothing was asked for."""
    of = lambda kind: F.filter(reasons, lambda r: r["criterion_type"] == kind)
    in_core = lambda r: r["field"].isin(*core)
    if words:
        direct = (F.size(of("query_term")) == len(words)) & F.forall(of("query_term"), in_core)
    else:
        direct = (F.size(of("filter")) == 0) | F.exists(of("filter"), in_core)
    return F.when(direct, "direct").otherwise("tangential")


def target_terms(request: Request) -> list[str]:
    """What a preview looks for: the query's terms, and the terms and the match key of each filter value."""
    found = terms(request.query)
    for _, chosen in request.filters.items():
        for value in chosen.values:
            found += [*terms(value), *([k] if (k := plain_match_key(value)) else [])]
    return list(dict.fromkeys(found))


def preview(candidates: Column, words: list[str], width: int = 320) -> Column:
    """struct(text, section, source_field, truncated) of the candidate (an array of structs of text, section and source_field)
    with the most of the words, the first of equals; cut at a blank after width characters. Null without a candidate that
    has text."""
    named = F.filter(F.transform(candidates, lambda c: F.struct(F.trim(c["text"]).alias("text"), c["section"].alias("section"), c["source_field"].alias("source_field"))), lambda c: c["text"] != "")
    hits = lambda c: sum((F.lower(c["text"]).contains(w).cast("int") for w in words), F.lit(0))
    best = F.array_max(F.transform(named, lambda c, i: F.struct(hits(c).alias("s"), (-i).alias("i"), c.alias("c"))))["c"]
    long = F.length(best["text"]) > width
    return F.when(best.isNotNull(), F.struct(F.when(long, clip(best["text"], width)).otherwise(best["text"]).alias("text"), best["section"].alias("section"), best["source_field"].alias("source_field"), long.alias("truncated")))
