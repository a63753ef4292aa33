"""Problem 6: values typed freely, mapped to a canonical list.

Method: a BK-tree over all keys of the reference list under the true Damerau-Levenshtein metric (edits of a
transposed pair keep the triangle inequality, unlike the optimal string alignment distance). The trees of at
most MAX_ENTITIES entities are sent with a function; a longer list makes several shards, whose winners are merged. Every entry within the
threshold is returned by triangle-inequality pruning; the nearest entity wins. Each different value is searched once.

The list has names in two languages and few aliases. Names in others are learned from titles of one study in two languages
(Learner): what stands in foreign titles of studies of an entity, and nowhere else, where none of its known names stands. They
are counted over all pairs of titles; on few titles fewer names are learned, and values in them are reported unmatched.

Defined results: a null value, a null array and an empty array give no row. A value without letters or digits, or
nearest to two entities at once, stands for no entity: unmatched. Inactive entities count like active ones. Long values
are compared whole; a value longer than every key by more than the threshold is unmatched.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import groupby

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from litscout.session import cut, table
from litscout.sources.readers import table_or_empty

MAX_ENTITIES = 20_000  #: of one shard
UNMATCHED = "unmatched"
#: Fields of corpus_record and the entity type that fits each.
FIELDS = {"legacy_study_type": "study_type", "medical_condition_labels": "medical_condition", "cannabinoid_labels": "cannabinoid"}

# Notes that people add after a value.
NOTES = ("nos", "unspecified", "adults", "other", "adult", "children", "sp", "etc")

COUNTS = 200_000  #: counts that a task sums up before it gives them on
LONGEST_NAME, LONGEST_TITLE = 6, 400  #: words of a name, letters of a title
SUPPORT, SHARE = 4, 0.02  #: titles that have a name, at least, and as a share of the entity's
SURE = 0.9  #: share of the titles with a name that are of its entity
LIFT = 1.8  #: how much more often the first and last word of a name stand with its entity than they would by chance


def distance(a: str, b: str, limit: int) -> int:
    """True Damerau-Levenshtein distance, or limit + 1 if it is more than limit."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > limit:
        return limit + 1
    big, last = len(a) + len(b), {}
    rows = [[big] * (len(b) + 2), [big, *range(len(b) + 1)]]
    for i, x in enumerate(a, 1):
        row, match = [big, i], 0
        for j, y in enumerate(b, 1):
            k, m = last.get(y, 0), match
            cost = 0 if x == y else 1
            if not cost:
                match = j
            row.append(min(rows[i][j] + cost, row[j] + 1, rows[i][j + 1] + 1, rows[k][m] + i - k - 1 + 1 + j - m - 1))
        rows.append(row)
        last[x] = i
    return min(rows[-1][-1], limit + 1)


class Tree:
    """BK-tree: children hang at their distance from the parent; a search visits only those the triangle inequality leaves."""

    def __init__(self, keys: Iterable[tuple[str, str]]) -> None:
        self.root, self.values = None, {}
        for key, value in keys:
            self.values.setdefault(key, set()).add(value)
        for key in sorted(self.values):
            self._add(key)

    def _add(self, key: str) -> None:
        if self.root is None:
            self.root = (key, {})
            return
        node = self.root
        while True:
            d = distance(key, node[0], max(len(key), len(node[0])))  # exact
            if d not in node[1]:
                node[1][d] = (key, {})
                return
            node = node[1][d]

    def within(self, query: str, limit: int) -> list[tuple[int, str]]:
        """All (distance, key) with a distance of at most limit; a key met exactly comes alone, since none is nearer."""
        if query in self.values:
            return [(0, query)]
        out, stack = [], [self.root] if self.root else []
        while stack:
            key, children = stack.pop()
            # The exact distance is needed only as far as the farthest child that it could leave.
            d = distance(query, key, limit + max(children, default=0))
            if d <= limit:
                out.append((d, key))
            stack.extend(child for at, child in children.items() if abs(at - d) <= limit)
        return out


def plain(text: str) -> str:
    """Letters without marks, lower case, words and digits between single blanks."""
    folded = unicodedata.normalize("NFKD", text.replace("ß", "ss").replace("_", " "))
    return " ".join(re.findall(r"[^\W_]+", "".join(ch for ch in folded if not unicodedata.combining(ch)).lower()))


def threshold(key: str) -> int:
    """Edits allowed for a key: abbreviations none, longer keys one or two."""
    return 0 if len(key) < 5 else 1 if len(key) < 9 else 2


def readings(raw: str) -> list[str]:
    """The keys a typed value may stand for, the most literal first: whole, turned at a comma or bracket, without an
    added note or bracket, as a dotted abbreviation, and without a plural."""
    out = [plain(raw)]
    if m := re.match(r"\s*(.+?)\s*\(([^()]+)\)\W*$", raw):
        out += [plain(f"{m[2]} {m[1]}"), plain(m[1]), plain(m[2])]
    if m := re.match(r"\s*([^,]+),\s*([^,]+)$", raw):
        out.append(plain(f"{m[2]} {m[1]}"))
    if re.fullmatch(r"\W*(?:\w\W+){1,}\w\W*", raw):
        out.append(re.sub(r"\W", "", plain(raw)))
    words = out[0].split()
    if len(words) > 1 and words[-1] in NOTES:
        out.append(" ".join(words[:-1]))
    out += [key[:-1] for key in list(out) if len(key) > 5 and key.endswith("s")]
    return [key for key in dict.fromkeys(out) if key]


def known_keys(entity) -> set[str]:
    """Labels, slug and aliases of an entity, plain."""
    names = [entity["canonical_label"], entity["canonical_label_en"], entity["slug"], *json.loads(entity["aliases_json"] or "[]")]
    return {plain(n) for n in names if n and plain(n)}


class Learner:
    """Names of entities learned from pairs (English title, title in any language)."""

    def __init__(self, entities: list) -> None:
        self.entities = {e["entity_id"]: (e["entity_type"], plain(e["canonical_label_en"]), known_keys(e)) for e in entities if e["canonical_label_en"] and plain(e["canonical_label_en"])}

    def unnamed(self, english: str, other: str) -> list[str]:
        """Entities that the English title has and the other has by none of their known names."""
        a, b = f" {plain(english)} ", f" {plain(other)} "
        return [i for i, (_, label, keys) in self.entities.items() if f" {label} " in a and not any(f" {k} " in b for k in keys)]

    def counts(self, batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """(entity, gram, n): how many titles (english, other) that lack known names have each sequence of words, once for all of
        them (entity null) and once for each such entity, of whose titles the empty sequence counts all. Partial sums."""
        held: Counter = Counter()
        give = lambda: pd.DataFrame([(e, g, n) for (e, g), n in held.items()], columns=["entity", "gram", "n"])
        for df in batches:
            for english, other in zip(df["english"], df["other"]):
                if named := self.unnamed(english, other):
                    w = plain(other).split()
                    own = {" ".join(w[i : i + k]) for k in range(1, LONGEST_NAME + 1) for i in range(len(w) - k + 1)}
                    held.update((e, g) for e in (None, *named) for g in own)
                    held.update((e, "") for e in named)
                if len(held) > COUNTS:
                    yield give()
                    held.clear()
        if held:
            yield give()

    def learn(self, pairs: DataFrame) -> dict[str, set[str]]:
        """entity -> names: sequences of words that titles of the entity have and hardly any others, that neither begin nor end
        with a word of all titles, and that are no part of longer names that explain where they stand. All pairs are counted;
        only what may be a name comes to the driver."""
        counts = cut(pairs.mapInPandas(self.counts, "entity string, gram string, n bigint").groupBy("entity", "gram").agg(F.sum("n").alias("n")))
        of = {r["entity"]: r["n"] for r in counts.where("entity is not null and gram = ''").collect()}  # as many as entities
        if not of:
            return {}
        kind = {e: self.entities[e][0] for e in of}
        kinds, alike = Counter(), Counter(kind.values())
        for e, n in of.items():
            kinds[kind[e]] += n
        least = [(e, kind[e], max(float(SUPPORT), SHARE * n), min(0.9, LIFT * max(1 / alike[kind[e]], n / kinds[kind[e]]))) for e, n in of.items()]
        both = counts.where("gram <> ''").join(F.broadcast(counts.sparkSession.createDataFrame(least, "entity string, kind string, support double, share double")), "entity")
        words = both.where(~F.col("gram").contains(" "))
        totals = words.groupBy("kind", "gram").agg(F.sum("n").alias("total"))
        telling = words.join(totals, ["kind", "gram"]).where("n >= share * total").select("entity", F.col("gram").alias("word"))
        every = counts.where("entity is null").select("gram", F.col("n").alias("total"))
        sure = both.where("n >= support").join(every, "gram").where(F.col("n") >= SURE * F.col("total")).select("entity", "gram", "n")
        for at in (1, -1):
            sure = sure.withColumn("word", F.element_at(F.split("gram", " "), at)).join(telling, ["entity", "word"]).drop("word")
        found: dict[str, dict[str, int]] = {}
        for r in sure.collect():
            found.setdefault(r["entity"], {})[r["gram"]] = r["n"]
        inside = lambda a, b: a != b and f" {a} " in f" {b} "
        out: dict[str, set[str]] = {}
        for e, names in found.items():
            whole = {g for g in names if not any(inside(g, h) and names[h] >= 0.8 * names[g] for h in names)}
            tops = [h for h in whole if not any(inside(h, k) for k in whole)]
            out[e] = {g for g in whole if sum(names[h] for h in tops if inside(g, h)) < 0.7 * names[g]}
        return out


def learned_names(spark: SparkSession, sf: str, entities: list) -> dict[str, set[str]]:
    """Names learned from the titles of publications, and from first lines of documents that belong to one; from each different
    pair of titles that has an entity without a known name."""
    publication = table_or_empty(spark, f"{sf}/publication.parquet", "document_id string, title_en string, title_pt string").select("document_id", F.col("title_en").alias("english"), F.col("title_pt").alias("other"))
    lines = table_or_empty(spark, f"{sf}/documents.parquet", "study_document_id string, text string").select(F.col("study_document_id").alias("document_id"), F.regexp_extract("text", r"^\s*([^\n]*)", 1).alias("other")).where("document_id is not null")
    pairs = publication.select("english", "other").unionByName(lines.join(publication.select("document_id", "english"), "document_id").select("english", "other"))
    pairs = pairs.where((F.length("english") <= LONGEST_TITLE) & (F.length("other").between(1, LONGEST_TITLE)))
    # A number of parts of its own: their bytes are few, the work on them is not.
    return Learner(entities).learn(pairs.repartition(spark.sparkContext.defaultParallelism * 2, "english", "other").distinct())


def reference(entities: list, names: dict[str, set[str]] | None = None) -> dict[str, Tree]:
    """One tree for each entity type, of labels, slugs, aliases and learned names. A learned name that another entity of the type
    has, too, names none."""
    keys: dict[str, list[tuple[str, str]]] = {}
    for e in entities:
        keys.setdefault(e["entity_type"], []).extend((k, e["entity_id"]) for k in known_keys(e))
    kinds = {e["entity_id"]: e["entity_type"] for e in entities}
    have = {kind: {k for k, _ in pairs} for kind, pairs in keys.items()}
    times = Counter((kinds[i], n) for i, own in (names or {}).items() for n in own)
    for i, own in sorted((names or {}).items()):
        keys[kinds[i]].extend((n, i) for n in sorted(own) if times[kinds[i], n] == 1 and n not in have[kinds[i]])
    return {kind: Tree(pairs) for kind, pairs in keys.items()}


def winners(tree: Tree | None, raw: str) -> list[tuple[int, int, list[str]]]:
    """(reading, distance, entities): for each reading of a value the entities of the nearest keys within their threshold."""
    out = []
    for order, reading in enumerate(readings(raw) if tree else []):
        best: tuple[int, set[str]] = (99, set())
        for d, key in tree.within(reading, threshold(reading)):
            if d <= threshold(key) and d <= best[0]:
                best = (d, tree.values[key] | (best[1] if d == best[0] else set()))
        if best[1]:
            out.append((order, best[0], sorted(best[1])))
    return out


def settle(found: Iterable[tuple[int, int, list[str]]]) -> str:
    """The entity nearest to the first reading of least distance, of the winners of all shards; unmatched without one, or with
    several. What is met exactly ends the search: later readings are less literal."""
    best: tuple[int, set[str]] = (99, set())
    for order, own in groupby(sorted(found, key=lambda w: w[0]), key=lambda w: w[0]):
        if best[0] == 0:
            break
        for _, d, ids in own:
            if d <= best[0]:
                best = (d, set(ids) | (best[1] if d == best[0] else set()))
    return next(iter(best[1])) if len(best[1]) == 1 else UNMATCHED


def nearest(tree: Tree | None, raw: str) -> str:
    return settle(winners(tree, raw))


WINNERS = "array<struct<reading:int,distance:int,entities:array<string>>>"


def map_values(df: DataFrame, kind: str, value: str, shards: list[dict[str, Tree]], out: str = "entity_id") -> DataFrame:
    """Adds the entity each value stands for; kind: column with the entity type."""

    def searched(trees: dict[str, Tree]) -> Column:
        @F.pandas_udf(WINNERS)
        def search(kinds: pd.Series, values: pd.Series) -> pd.Series:
            return pd.Series([None if v is None else winners(trees.get(k), v) for k, v in zip(kinds, values)], dtype=object)

        return search(F.col(kind), F.col(value))

    @F.pandas_udf("string")
    def settled(values: pd.Series, *found: pd.Series) -> pd.Series:
        own = [[(w["reading"], w["distance"], list(w["entities"])) for ws in all_of if ws is not None for w in ws] for all_of in zip(*found)]
        return pd.Series([None if v is None else settle(ws) for v, ws in zip(values, own)], dtype=object)

    return df.withColumn(out, settled(F.col(value), *[searched(trees) for trees in shards or [{}]]))


def _cells(values: Column, field: str, kind: str) -> Column:
    return F.transform(values, lambda v: F.struct(F.lit(field).alias("field_name"), F.lit(kind).alias("entity_type"), v.alias("raw_value")))


def typed_values(spark: SparkSession, sf: str) -> DataFrame:
    """(document_id, field_name, entity_type, raw_value) of corpus_record, repeated rows once, without those that are a label of
    the fitting type to the letter."""
    records, listed = table(spark, sf, "corpus_record"), table(spark, sf, "ontology_entity")
    cells = []
    for field, kind in FIELDS.items():
        values = F.col(field) if isinstance(records.schema[field].dataType, T.ArrayType) else F.array(field)
        cells.append(_cells(values, field, kind))
    rows = records.select("document_id", F.explode(F.concat(*[F.coalesce(c, F.array().cast("array<struct<field_name:string,entity_type:string,raw_value:string>>")) for c in cells])).alias("v")).select("document_id", "v.*")
    labels = listed.select("entity_type", F.explode(F.array("canonical_label", "canonical_label_en")).alias("raw_value")).where("raw_value <> ''").distinct()
    return rows.where("raw_value is not null").distinct().join(labels, ["entity_type", "raw_value"], "left_anti")


def shards(spark: SparkSession, sf: str) -> list[dict[str, Tree]]:
    """The trees of all entities, MAX_ENTITIES in each shard."""
    columns = ["entity_id", "entity_type", "canonical_label", "canonical_label_en", "slug", "aliases_json"]
    parts: list[list] = [[]]
    for e in table(spark, sf, "ontology_entity").select(*columns).where("entity_id is not null").distinct().orderBy(*columns).toLocalIterator():
        if len(parts[-1]) == MAX_ENTITIES:
            parts.append([])
        parts[-1].append(e)
    return [reference(part, learned_names(spark, sf, part) if part else None) for part in parts]


def found(spark: SparkSession, sf: str) -> DataFrame:
    """Each different value is searched once, in as many tasks as there are cores: their bytes are few, the work on them is not."""
    rows = typed_values(spark, sf)
    values = rows.select("entity_type", "raw_value").distinct().repartition(spark.sparkContext.defaultParallelism * 2, "entity_type", "raw_value")
    mapped = map_values(values, "entity_type", "raw_value", shards(spark, sf))
    return rows.join(mapped, ["entity_type", "raw_value"]).select("document_id", "field_name", "raw_value", "entity_id")


def unmatched(spark: SparkSession, sf: str) -> DataFrame:
    """Values that stand for no entity, with the number of records that have them."""
    rows = found(spark, sf).where(F.col("entity_id") == UNMATCHED)
    return rows.groupBy("field_name", "raw_value").agg(F.count("*").alias("records"))


QUERIES = {"p6_found": found, "p6_unmatched": unmatched}
ORACLES: dict[str, str] = {}
