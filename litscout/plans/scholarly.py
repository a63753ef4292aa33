"""Search, facets, coverage and identity over documents, publications and candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litscout.functions import ids
from litscout.functions.text import blank_to_null
from litscout.operators import aggregates, index, joins, search, windows
from litscout.session import table

QUERY = "Cannabidiol and the weeks"
REQUEST = search.Request(query=QUERY, filters={"lang": search.Filter(("EN", "pt"))}, year_from=2008, limit=50)
BOTH = search.Request(filters={"topic": search.Filter(("Insomnia", "cannabidiol (CBD)", "insomnia"), all_of=True)})
QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    """Register a query under its name, with its SQL."""

    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def documents(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("document_id"), "publication_year", "lang", "source", "journal", "n_chars", "text")
    return docs.withColumn("search_text", index.search_text([F.col("text")])).withColumn("score", F.col("n_chars").cast("double"))


def facets(spark: SparkSession, sf: str) -> DataFrame:
    one = lambda c: F.when(F.col(c).isNotNull(), F.array(c)).otherwise(F.array().cast("array<string>"))
    return index.facet_rows(documents(spark, sf), {"lang": one("lang"), "source": one("source"), "journal": one("journal")})


def topics(spark: SparkSession, sf: str) -> DataFrame:
    """Facets of publications from their links: canonical rows by English label, alias rows by the Portuguese one."""
    entity = table(spark, sf, "ontology_entity").select("entity_id", "canonical_label", "canonical_label_en")
    linked = table(spark, sf, "document_ontology_link").select("document_id", "entity_id").distinct().join(F.broadcast(entity), "entity_id")  # a fixed table
    return index.facet_rows(linked, {"topic": F.array("canonical_label_en")}, {"topic": F.array(F.struct(F.col("canonical_label").alias("alias"), F.col("canonical_label_en").alias("display")))})


_TERMS = "lower(text) like '%cannabidiol%' and lower(text) like '%weeks%'"
_SELECTED = f"select doc_id, publication_year, lang, source, n_chars from documents where {_TERMS} and lang in ('en', 'pt') and publication_year >= 2008"
_SLUG = "trim(regexp_replace(lower(strip_accents({0})), '[^a-z0-9]+', ' ', 'g'))"


@query("search_terms_facets", f"select doc_id as document_id, publication_year, n_chars from ({_SELECTED}) order by n_chars desc nulls last, publication_year desc nulls last, doc_id limit 50")
def search_terms_facets(spark: SparkSession, sf: str) -> DataFrame:
    rows = search.select(documents(spark, sf), facets(spark, sf), REQUEST)
    return search.page(rows, [F.desc_nulls_last("score"), F.desc_nulls_last("publication_year"), F.asc("document_id")], REQUEST.limit).select("document_id", "publication_year", "n_chars")


@query("search_page", f"select doc_id as document_id from ({_SELECTED}) order by n_chars desc nulls last, publication_year desc nulls last, doc_id limit 20 offset 20")
def search_page(spark: SparkSession, sf: str) -> DataFrame:
    rows = search.select(documents(spark, sf), facets(spark, sf), REQUEST)
    return search.page(rows, [F.desc_nulls_last("score"), F.desc_nulls_last("publication_year"), F.asc("document_id")], 20, 20).select("document_id")


@query("search_total", f"select count(*) as total from ({_SELECTED})")
def search_total(spark: SparkSession, sf: str) -> DataFrame:
    return search.select(documents(spark, sf), facets(spark, sf), REQUEST).agg(F.count("*").alias("total"))


@query(
    "search_match_all",
    "select document_id from document_ontology_link l join ontology_entity e using (entity_id) where e.canonical_label_en in ('insomnia', 'cannabidiol') or e.canonical_label in ('insomnia', 'cannabidiol') "
    "group by document_id having count(distinct case when 'insomnia' in (canonical_label_en, canonical_label) then 1 else 2 end) = 2",
)
def search_match_all(spark: SparkSession, sf: str) -> DataFrame:
    ids_ = table(spark, sf, "publication").select("document_id").distinct()
    return search.with_facets(ids_, topics(spark, sf), BOTH.filters)


@query(
    "facet_counts",
    f"""with f as (select 'lang' as family, doc_id, lang as display from ({_SELECTED}) union all select 'source', doc_id, source from ({_SELECTED}) union all
      select 'journal', doc_id, journal from documents where doc_id in (select doc_id from ({_SELECTED}))),
    c as (select family, {_SLUG.format("display")} as value_key, min(display) as display, count(distinct doc_id) as documents from f where display is not null group by 1, 2),
    r as (select *, row_number() over (partition by family order by documents desc, display, value_key) as place from c)
    select family, value_key, display, documents, place from r where place <= 5""",
)
def facet_counts(spark: SparkSession, sf: str) -> DataFrame:
    chosen = search.select(documents(spark, sf), facets(spark, sf), REQUEST)
    return search.facet_counts(chosen, facets(spark, sf), 5)


@query(
    "facet_cardinality",
    f"select family, count(distinct value_key) as n from (select 'lang' as family, {_SLUG.format('lang')} as value_key from documents union all select 'source', {_SLUG.format('source')} from documents "
    f"union all select 'journal', {_SLUG.format('journal')} from documents) where value_key <> '' group by family",
)
def facet_cardinality(spark: SparkSession, sf: str) -> DataFrame:
    return facets(spark, sf).where("is_canonical").groupBy("family").agg(F.countDistinct("value_key").alias("n"))


@query(
    "facet_aliases",
    "select e.canonical_label_en as display, count(distinct l.document_id) as documents from document_ontology_link l join ontology_entity e using (entity_id) where e.canonical_label in ('insônia', 'enxaqueca', 'pele') group by 1",
)
def facet_aliases(spark: SparkSession, sf: str) -> DataFrame:
    rows = topics(spark, sf).where(~F.col("is_canonical") & F.col("value_key").isin("insonia", "enxaqueca", "pele"))
    return rows.groupBy("display").agg(F.countDistinct("document_id").alias("documents"))


@query(
    "match_kind",
    "select case when lower(string_split(text, chr(10))[1]) like '%insomnia%' and lower(string_split(text, chr(10))[1]) like '%children%' then 'direct' else 'tangential' end as kind, count(*) as n "
    "from documents where lower(text) like '%insomnia%' and lower(text) like '%children%' group by 1",
)
def match_kind(spark: SparkSession, sf: str) -> DataFrame:
    words = search.terms("insomnia in children")
    rows = documents(spark, sf).where(search.matches(F.col("search_text"), words))
    title = F.element_at(F.split("text", "\n"), 1)
    return rows.groupBy(search.match_kind(search.match_reasons({"title": F.array(title), "body": F.array("text")}, search.Request("insomnia in children")), {"title"}, words).alias("kind")).agg(F.count("*").alias("n"))


@query(
    "match_reasons",
    """with d as (select doc_id, lower(text) as t, string_split(text, chr(10))[1] as title, lang, publication_year from documents where lower(text) like '%insomnia%' and lang in ('en', 'de') and publication_year >= 2010),
    r as (select 'insomnia' as criterion, case when lower(title) like '%insomnia%' then 'title' else 'body' end as field from d union all select 'lang:EN', 'lang' from d where lang = 'en' union all select 'lang:de', 'lang' from d where lang = 'de'
      union all select 'publication_year_from:2010', 'publication_year' from d)
    select criterion, field, count(*) as n from r group by 1, 2""",
)
def match_reasons(spark: SparkSession, sf: str) -> DataFrame:
    """Why documents match a request, counted: query terms, filter values, years."""
    request = search.Request("the Insomnia", {"lang": search.Filter(("EN", "de"))}, year_from=2010)
    rows = search.select(documents(spark, sf), facets(spark, sf), request)
    year = F.array(F.col("publication_year").cast("string"))
    fields = {"title": F.array(F.element_at(F.split("text", "\n"), 1)), "body": F.array("text"), "lang": F.array("lang"), "publication_year": year}
    return rows.select(F.explode(search.match_reasons(fields, request)).alias("r")).groupBy("r.criterion", "r.field").agg(F.count("*").alias("n"))


@query(
    "evidence_preview",
    """with l as (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as i from documents where lower(text) like '%insomnia%'),
    r as (select doc_id, trim(line) as t, row_number() over (partition by doc_id order by (case when lower(line) like '%insomnia%' then 1 else 0 end) + (case when lower(line) like '%sleep%' then 1 else 0 end) desc, i) as n from l where trim(line) <> '')
    select doc_id as document_id, case when length(t) > 320 then coalesce(nullif(regexp_extract(substr(t, 1, 320), '^(.*) ', 1), ''), substr(t, 1, 320)) else t end as preview, length(t) > 320 as truncated from r where n = 1""",
)
def evidence_preview(spark: SparkSession, sf: str) -> DataFrame:
    """For each document on insomnia the line that has most of what is looked for."""
    rows = documents(spark, sf).where(search.matches(F.col("search_text"), ["insomnia"]))
    candidates = F.transform(F.split("text", "\n"), lambda line: F.struct(line.alias("text"), F.lit(None).cast("string").alias("section"), F.lit("text").alias("source_field")))
    wanted = search.target_terms(search.Request("Insomnia", {"topic": search.Filter(("sleep",))}))
    return rows.withColumn("p", search.preview(candidates, wanted)).select("document_id", F.col("p.text").alias("preview"), "p.truncated")


@query(
    "identity_coverage",
    "select (case when pmid is not null then 1 else 0 end) + (case when doi is not null then 1 else 0 end) + (case when normalized_title is not null then 1 else 0 end) as identifiers, count(*) as n from pubmed_candidate group by 1",
)
def identity_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.identifier_counts(table(spark, sf, "pubmed_candidate"), [F.col("pmid"), F.col("doi"), F.col("normalized_title")])


_COVERED = {"title_pt": "title_pt", "title_en": "title_en", "abstract": "abstract", "language": "language", "year": "publication_year"}


@query(
    "coverage_percent",
    " union all ".join(
        f"select '{n}' as field, count(*) filter (where {c} is not null and trim(cast({c} as varchar)) <> '') as present, count(*) as total, "
        f"coalesce(round(100.0 * count(*) filter (where {c} is not null and trim(cast({c} as varchar)) <> '') / count(*), 2), 0.0) as percent from publication"
        for n, c in _COVERED.items()
    ),
)
def coverage_percent(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.coverage(table(spark, sf, "publication"), {n: blank_to_null(F.col(c).cast("string")).isNotNull() for n, c in _COVERED.items()})


@query(
    "identity_projection",
    """with v as (select document_id, 'pmid' as kind, nullif(regexp_replace(regexp_extract(pmid, '(\\d+)', 1), '^0+', ''), '') as value, 'index' as source from legacy_index
      union all select document_id, 'year', cast(publication_year as varchar), 'index' from legacy_index union all select document_id, 'year', cast(publication_year as varchar), 'study' from legacy_study where document_id is not null),
    d as (select distinct document_id, kind, value, source from v where value is not null),
    p as (select document_id, kind, value, value || '<-' || array_to_string(list_sort(list(source)), '+') as c from d group by document_id, kind, value)
    select document_id, kind, case when count(*) = 1 then 'accepted' else 'conflict' end as state, case when count(*) = 1 then min(value) end as value,
      string_agg(c, ';' order by value) as candidates, count(*) as distinct_values from p group by document_id, kind""",
)
def identity_projection(spark: SparkSession, sf: str) -> DataFrame:
    old, study = table(spark, sf, "legacy_index"), table(spark, sf, "legacy_study")
    number = F.nullif(F.regexp_replace(F.regexp_extract("pmid", r"(\d+)", 1), "^0+", ""), F.lit(""))
    row = lambda df, kind, value, source: df.select("document_id", F.lit(kind).alias("kind"), value.alias("value"), F.lit(source).alias("source"))
    year = F.col("publication_year").cast("string")
    rows = row(old, "pmid", number, "index").unionByName(row(old, "year", year, "index")).unionByName(row(study.where("document_id is not null"), "year", year, "study"))
    shown = F.array_join(F.transform("candidates", lambda c: F.concat(c["value"], F.lit("<-"), F.array_join(c["sources"], "+"))), ";")
    return aggregates.project_identity(rows, "document_id", "kind", "value", "source").withColumn("candidates", shown)


@query(
    "priority_lookup",
    """with c as (select candidate_id, nullif(regexp_replace(regexp_extract(pmid, '(\\d+)', 1), '^0+', ''), '') as p, lower(trim(doi)) as d, lower(normalized_title) as t from pubmed_candidate),
    k as (select document_id, nullif(regexp_replace(regexp_extract(pmid, '(\\d+)', 1), '^0+', ''), '') as p, lower(trim(doi)) as d, lower(normalized_title) as t from legacy_index),
    h as (select candidate_id, 0 as rank, 'pmid' as method, document_id from c join k using (p) union all select candidate_id, 1, 'doi', document_id from c join k using (d) union all select candidate_id, 2, 'title', document_id from c join k using (t)),
    b as (select candidate_id, min(rank) as rank from h group by 1)
    select c.candidate_id, x.method, x.document_id from c left join (select h.candidate_id, h.method, min(h.document_id) as document_id from h join b using (candidate_id, rank) group by 1, 2) x on x.candidate_id = c.candidate_id""",
)
def priority_lookup(spark: SparkSession, sf: str) -> DataFrame:
    shape = lambda df, key: df.select(key, F.nullif(F.regexp_replace(F.regexp_extract("pmid", r"(\d+)", 1), "^0+", ""), F.lit("")).alias("p"), F.lower(F.trim("doi")).alias("d"), F.lower("normalized_title").alias("t"))
    left, right = shape(table(spark, sf, "pubmed_candidate"), "candidate_id"), shape(table(spark, sf, "legacy_index"), "document_id")
    return joins.priority_lookup(left, right, "candidate_id", [("pmid", "p", "p"), ("doi", "d", "d"), ("title", "t", "t")], "document_id")


@query(
    "multi_key_match",
    """with a as (select document_id, pmid as p, lower(regexp_replace(trim(doi), '[).,;\\]]+$', '')) as d, lower(trim(normalized_title)) as t from legacy_index),
    b as (select candidate_id, pmid as p, lower(regexp_replace(trim(doi), '[).,;\\]]+$', '')) as d, lower(trim(normalized_title)) as t from pubmed_candidate),
    h as (select document_id, candidate_id, 'pmid' as m from a join b using (p) union select document_id, candidate_id, 'doi' from a join b using (d) union select document_id, candidate_id, 'normalized_title' from a join b using (t))
    select document_id, candidate_id, string_agg(m, '+' order by m) as methods from h group by 1, 2""",
)
def multi_key_match(spark: SparkSession, sf: str) -> DataFrame:
    """Candidates that have an identifier or the title of an earlier index, with all the methods that say so."""
    shape = lambda name, key: table(spark, sf, name).select(key, F.col("pmid").alias("p"), ids.trimmed_doi(F.col("doi")).alias("d"), F.lower(F.trim("normalized_title")).alias("t"))
    return joins.multi_key_match(shape("legacy_index", "document_id"), shape("pubmed_candidate", "candidate_id"), "document_id", "candidate_id", [("pmid", "p", "p"), ("doi", "d", "d"), ("normalized_title", "t", "t")])


@query(
    "completeness_check",
    "select 'only_left' as side, count(distinct document_id) as missing from publication where document_id not in (select document_id from corpus_record where document_id is not null) union all "
    "select 'only_right', count(distinct document_id) from corpus_record where document_id not in (select document_id from publication where document_id is not null)",
)
def completeness_check(spark: SparkSession, sf: str) -> DataFrame:
    return joins.completeness(table(spark, sf, "publication"), table(spark, sf, "corpus_record"), "document_id")


@query("fuzzy_title")
def fuzzy_title(spark: SparkSession, sf: str) -> DataFrame:
    """Candidates whose title is nearly one of the earlier index, in two classes."""
    return joins.fuzzy_titles(table(spark, sf, "pubmed_candidate"), table(spark, sf, "legacy_index"), "candidate_id", "document_id", "title", "normalized_title", "publication_year", "publication_year")


@query(
    "ontology_labels",
    """select l.document_id, array_to_string(list_sort(list_distinct(list(e.canonical_label_en) filter (where e.entity_type = 'medical_condition'))), ';') as conditions,
      array_to_string(list_sort(list_distinct(list(e.canonical_label_en) filter (where e.entity_type = 'cannabinoid'))), ';') as cannabinoids
    from document_ontology_link l join ontology_entity e using (entity_id) group by l.document_id""",
)
def ontology_labels(spark: SparkSession, sf: str) -> DataFrame:
    entity = table(spark, sf, "ontology_entity").select("entity_id", F.col("entity_type").alias("kind"), "canonical_label_en")
    linked = table(spark, sf, "document_ontology_link").select("document_id", "entity_id").join(F.broadcast(entity), "entity_id")  # a fixed table
    labels = lambda kind: F.array_join(F.array_sort(F.collect_set(F.when(F.col("kind") == kind, F.col("canonical_label_en")))), ";")
    joined = linked.groupBy("document_id").agg(labels("medical_condition").alias("conditions"), labels("cannabinoid").alias("cannabinoids"))
    empty_to_null = lambda c: F.nullif(F.col(c), F.lit("")).alias(c)
    return joined.select("document_id", empty_to_null("conditions"), empty_to_null("cannabinoids"))


@query(
    "best_source",
    """select document_id, source_candidate_id, extracted_text_chars from (select *, row_number() over (partition by document_id order by coalesce(extracted_text_chars >= 4000 and scientific_section_hit_count >= 2, false) desc,
      coalesce(extracted_text_chars, -1) desc, source_candidate_id) as n from (select distinct document_id, source_candidate_id, extracted_text_chars, scientific_section_hit_count from source_candidate)) where n = 1""",
)
def best_source(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "source_candidate").select("document_id", "source_candidate_id", "extracted_text_chars", "scientific_section_hit_count")
    ready = F.coalesce((F.col("extracted_text_chars") >= 4000) & (F.col("scientific_section_hit_count") >= 2), F.lit(False))
    best = windows.best_per_key(rows, ["document_id"], [ready.alias("ready"), F.coalesce("extracted_text_chars", F.lit(-1)).alias("chars"), (-F.col("source_candidate_id")).alias("tie")])
    return best.select("document_id", "source_candidate_id", "extracted_text_chars")


@query(
    "stable_ids",
    """select document_id, 'publication:' || coalesce('doi:' || substr(sha256(nullif(lower(trim(doi)), '')), 1, 16), 'url:' || substr(sha256(canonical_url), 1, 16), 'legacy:' || document_id) as stable_id from documents""",
)
def stable_ids(spark: SparkSession, sf: str) -> DataFrame:
    none = F.lit(None).cast("string")
    made = ids.stable_id(none, none, F.nullif(F.lower(F.trim("doi")), F.lit("")), F.col("canonical_url"), none, F.col("document_id"))
    return table(spark, sf, "documents").select("document_id", made.alias("stable_id"))


@query(
    "record_hashes",
    r"""select document_id, substr(sha256('{"document_id": ' || coalesce('"' || document_id || '"', 'null') || ', "journal": ' || coalesce('"' || replace(replace(journal, '\', '\\'), '"', '\"') || '"', 'null') || '}'), 1, 24) as record_hash from publication""",
)
def record_hashes(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "publication").select("document_id", ids.record_hash({"document_id": F.col("document_id"), "journal": F.col("journal")}).alias("record_hash"))


@query(
    "url_hosts",
    r"""select document_id, nullif(regexp_replace(lower(regexp_extract(canonical_url, '(?i)^\s*[a-z][a-z0-9+.-]*://([^/?#:\s]+)', 1)), '^www\.', ''), '') as host,
      lower(regexp_extract(canonical_url, '(?i)^\s*([a-z][a-z0-9+.-]*)://', 1)) as scheme from documents""",
)
def url_hosts(spark: SparkSession, sf: str) -> DataFrame:
    scheme = F.lower(F.regexp_extract("canonical_url", r"(?i)^\s*([a-z][a-z0-9+.-]*)://", 1))
    return table(spark, sf, "documents").select("document_id", ids.url_host(F.col("canonical_url")).alias("host"), scheme.alias("scheme"))


@query(
    "identifier_from_url",
    r"""with u as (select candidate_id, 'https://pubmed.ncbi.nlm.nih.gov/' || trim(pmid) || '/?x=1' as p, 'see https://dx.doi.org/' || trim(doi) || '#top' as d, 'https://pmc.ncbi.nlm.nih.gov/articles/pmc' || candidate_id || '/' as c from pubmed_candidate)
    select candidate_id, nullif(regexp_extract(p, 'gov/(\d{5,9})(/|$)', 1), '') as pmid, nullif(regexp_extract(d, '(?i)doi\.org/(10\.\d{4,9}/[^?#\s]+)', 1), '') as doi, 'pmc' || candidate_id as pmcid from u""",
)
def identifier_from_url(spark: SparkSession, sf: str) -> DataFrame:
    """Identifiers of all candidates read back from addresses made of them as they are written."""
    c = table(spark, sf, "pubmed_candidate")
    made = {"pmid": F.concat(F.lit("https://pubmed.ncbi.nlm.nih.gov/"), F.trim("pmid"), F.lit("/?x=1")), "doi": F.concat(F.lit("see https://dx.doi.org/"), F.trim("doi"), F.lit("#top")), "pmcid": F.concat(F.lit("https://pmc.ncbi.nlm.nih.gov/articles/pmc"), "candidate_id", F.lit("/"))}
    return c.select("candidate_id", *[ids.from_address(kind, url).alias(kind) for kind, url in made.items()])


@query(
    "article_metadata",
    """select candidate_id, pmid || ':nxml_article_id' as pmids, coalesce(lower(doi), 'none') || ':html_citation_meta' as dois from pubmed_candidate where pmid is not null""",
)
def article_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """Identifiers of candidates read from articles made of them; the id of a cited work, outside article-meta, is not read."""
    rows = table(spark, sf, "pubmed_candidate").where("pmid is not null").withColumn("d", F.coalesce(F.lower("doi"), F.lit("none")))
    head = F.concat(F.lit("<article><article-meta><article-id pub-id-type='pmid'>"), "pmid", F.lit("</article-id></article-meta><ref><article-id pub-id-type='pmid'>99999999</article-id></ref></article>"))
    page = F.concat(head, F.lit("<meta content=\""), "d", F.lit("\" name=\"citation_doi\"/>"))
    shown = lambda kind: F.array_join(F.transform(ids.from_article(kind, page), lambda v: F.concat(v["value"], F.lit(":"), v["method"])), ";")
    return rows.select("candidate_id", shown("pmid").alias("pmids"), shown("doi").alias("dois"))


@query(
    "preferred_urls",
    r"""with c as (select candidate_id, case when regexp_full_match(trim(pmid), '\d{5,9}') then trim(pmid) end as p, case when regexp_full_match(lower(rtrim(trim(doi), '.,;)')), '10\.\d{4,9}/\S+') then lower(rtrim(trim(doi), '.,;)')) end as d from pubmed_candidate)
    select candidate_id, case when p is not null then 'pubmed' when d is not null then 'doi' else 'canonical' end as url_kind,
      coalesce('https://pubmed.ncbi.nlm.nih.gov/' || p || '/', 'https://doi.org/' || d, 'https://x.example/' || candidate_id) as url, 2 + (case when p is null then 0 else 1 end) + (case when d is null then 0 else 1 end) as urls from c""",
)
def preferred_urls(spark: SparkSession, sf: str) -> DataFrame:
    """The address to show for each candidate, and how many it has."""
    own, machine = F.concat(F.lit("https://x.example/"), "candidate_id"), F.concat(F.lit("https://api.openalex.org/"), "candidate_id")
    rows = table(spark, sf, "pubmed_candidate").select("candidate_id", ids.identity_urls(ids.identifier("pmid", F.col("pmid"))["value"], F.lit(None).cast("string"), ids.identifier("doi", F.col("doi"))["value"], own, machine).alias("u"))
    return rows.withColumn("p", ids.preferred_url(F.col("u"))).select("candidate_id", "p.url_kind", "p.url", F.size("u").alias("urls"))


@query(
    "identifiers_normalized",
    r"""with v as (select 'pmid' as kind, pmid as g, nullif(regexp_extract(rtrim(regexp_replace(trim(trim(pmid), '<>"'''), '^(PMID:|https?://pubmed\.ncbi\.nlm\.nih\.gov/)', '', 'i'), '/'), '^\d{5,9}$'), '') as value, 'trim_prefix_and_slash.v1' as rule from pubmed_candidate
      union all select 'doi', doi, nullif(regexp_extract(rtrim(lower(regexp_replace(trim(trim(doi), '<>"'''), '^https?://(dx\.)?doi\.org/', '', 'i')), '.,;)'), '^10\.\d{4,9}/\S+$'), ''), 'lowercase_and_trim_punctuation.v1' from pubmed_candidate)
    select kind, case when value is not null then rule end as rule, g is not null as given, count(*) as n, count(distinct value) as about_distinct from v group by 1, 2, 3""",
)
def identifiers_normalized(spark: SparkSession, sf: str) -> DataFrame:
    """Plain identifiers of candidates and the rule each needed, counted by kind."""
    rows = table(spark, sf, "pubmed_candidate").select(F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), ids.identifier(k, F.col(k)).alias("id"), F.col(k).isNotNull().alias("given")) for k in ("pmid", "doi")])).alias("r"))
    return rows.groupBy("r.kind", "r.id.rule", "r.given").agg(F.count("*").alias("n"), F.count_distinct("r.id.value").alias("about_distinct"))


@query(
    "top_domains",
    r"""select host, count(*) as n from (select regexp_replace(lower(regexp_extract(canonical_url, '(?i)^\s*[a-z][a-z0-9+.-]*://([^/?#:\s]+)', 1)), '^www\.', '') as host from documents) where host <> '' group by host order by n desc, host limit 10""",
)
def top_domains(spark: SparkSession, sf: str) -> DataFrame:
    hosts = table(spark, sf, "documents").select(ids.url_host(F.col("canonical_url")).alias("host")).where("host is not null")
    return hosts.groupBy("host").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "host").limit(10)


@query("path_redaction", "select source_candidate_id, 'sha256:' || sha256(source_text_path) as reference from (select distinct source_candidate_id, source_text_path from source_candidate) where source_text_path is not null")
def path_redaction(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "source_candidate").where("source_text_path is not null").select("source_candidate_id", "source_text_path").distinct()
    return rows.select("source_candidate_id", F.concat(F.lit("sha256:"), F.sha2("source_text_path", 256)).alias("reference"))
