"""A published index as one object: search, facets, single documents, coverage and capabilities."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from litscout.operators import aggregates, index, search

LIMITS = {"limit": search.MOST_ROWS, "values": search.MOST_VALUES, "facet_top": search.MOST_FACETS}


def build(documents: DataFrame, folder: str, text: Sequence[str], families: dict[str, Column], aliases: dict[str, Column] | None = None) -> str:
    """Publish an index of documents (document_id, publication_year, …): search_text from the columns named in text, facets by
    family, written by family so that a filter reads one family only. ValueError if a document_id occurs twice."""
    from litscout.operators.joins import require_unique

    rows = require_unique(documents, "document_id").withColumn("search_text", index.search_text([F.col(c) for c in text]))
    return index.publish({"documents": rows, "facets": index.facet_rows(rows, families, aliases)}, folder, {"facets": ["family"]})


class Engine:
    """Answers from the version of the index that was current when the engine was made."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.build_id = json.loads(spark.read.text(f"{folder}/CURRENT", wholetext=True).first()[0])["build"]
        frames = index.current(spark, folder)
        self.documents, self.facet_rows = frames["documents"], frames["facets"]

    def search(self, request: search.Request) -> tuple[DataFrame, dict]:
        return search.search(self.documents, self.facet_rows, request, self.build_id)

    def results(self, request: search.Request, fields: dict[str, Column], core: set[str], candidates: Column | None = None) -> tuple[DataFrame, dict]:
        """A page with why each document matches (reasons, match) and the evidence that shows it best (preview, from candidates), and
        its envelope. fields: arrays of values in which query terms and filter values are looked for, in that order."""
        page, envelope = self.search(request)
        explained = page.withColumn("reasons", search.match_reasons(fields, request)).withColumn("match", search.match_kind(F.col("reasons"), core, search.terms(request.query)))
        return (explained.withColumn("preview", search.preview(candidates, search.target_terms(request))) if candidates is not None else explained), envelope

    def facets(self, request: search.Request, top: int = 25) -> DataFrame:
        return search.facet_counts(search.select(self.documents, self.facet_rows, request), self.facet_rows, top)

    def get(self, document_id) -> dict:
        """One document; KeyError if there is none."""
        row = self.documents.where(F.col("document_id") == document_id).first()
        if row is None:
            raise KeyError(document_id)
        return row.asDict(recursive=True)

    def coverage(self, columns: Sequence[str]) -> DataFrame:
        return aggregates.coverage(self.documents, {c: F.col(c).isNotNull() for c in columns})

    def capabilities(self) -> dict:
        """Families with their number of canonical values, fields and limits."""
        counts = self.facet_rows.where("is_canonical").groupBy("family").agg(F.countDistinct("value_key").alias("n"))
        return {"build": self.build_id, "families": {r["family"]: r["n"] for r in counts.collect()}, "fields": self.documents.columns, "limits": LIMITS}
