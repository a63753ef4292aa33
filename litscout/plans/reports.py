"""Assembled records, samples, reports and checks over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litscout.functions import ids
from litscout.functions import text as tx
from litscout.operators import aggregates, assembly, evidence, windows
from litscout.session import fixed_size, table

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


@query(
    "publication_detail",
    """with l as (select document_id, count(*) as links, string_agg(link_id, ';' order by link_id) as link_ids from (select distinct document_id, link_id from document_ontology_link) group by 1),
    s as (select document_id, count(*) as sources, min(source_candidate_id) as first_source from (select distinct document_id, source_candidate_id from source_candidate) group by 1)
    select p.document_id, coalesce(links, 0) as links, coalesce(link_ids, '') as link_ids, coalesce(sources, 0) as sources, first_source from publication p left join l using (document_id) left join s using (document_id)""",
)
def publication_detail(spark: SparkSession, sf: str) -> DataFrame:
    links = table(spark, sf, "document_ontology_link").select("document_id", "link_id").distinct()
    sources = table(spark, sf, "source_candidate").select("document_id", "source_candidate_id", F.lower("source_strategy").alias("strategy")).dropDuplicates(["document_id", "source_candidate_id"])
    whole = assembly.detail(table(spark, sf, "publication").select("document_id"), "document_id", {"links": (links, ["link_id"]), "sources": (sources, ["source_candidate_id"])})
    return whole.select(
        "document_id", F.size("links").cast("bigint").alias("links"), F.array_join("links.link_id", ";").alias("link_ids"), F.size("sources").cast("bigint").alias("sources"),
        F.try_element_at("sources", F.lit(1))["source_candidate_id"].alias("first_source"),
    )


@query(
    "payload_overlay",
    """select s.legacy_id, coalesce(nullif(trim(p.title_pt), ''), nullif(trim(s.title_pt), '')) as title_pt, coalesce(nullif(trim(p.legacy_result), ''), nullif(trim(s.legacy_result), '')) as legacy_result,
      coalesce(cast(i.publication_year as varchar), cast(s.publication_year as varchar)) as year from legacy_study s left join publication p on p.document_id = s.document_id left join legacy_index i on i.document_id = p.document_id""",
)
def payload_overlay(spark: SparkSession, sf: str) -> DataFrame:
    """Earlier studies, with what their publication and its index entry say before what they say themselves."""
    study = table(spark, sf, "legacy_study").select("legacy_id", "document_id", F.create_map(F.lit("title_pt"), "title_pt", F.lit("legacy_result"), "legacy_result", F.lit("year"), F.col("publication_year").cast("string")).alias("payload"))
    publication = table(spark, sf, "publication").select("document_id", "title_pt", "legacy_result")
    index = table(spark, sf, "legacy_index").select("document_id", F.col("publication_year").cast("string").alias("year"))
    chain = study.join(publication, "document_id", "left").join(index, "document_id", "left")
    return chain.select("legacy_id", *assembly.overlay({c: F.col(c) for c in ("title_pt", "legacy_result", "year")}, F.col("payload"), F.lit(None).cast("map<string,string>")).values())


@query(
    "outputs_matched",
    "select l_returnflag, count(o_orderkey) as matched, count(*) - count(o_orderkey) as unmatched from lineitem left join (select o_orderkey from orders where o_orderstatus = 'O') on o_orderkey = l_orderkey group by 1",
)
def outputs_matched(spark: SparkSession, sf: str) -> DataFrame:
    manifest = table(spark, sf, "orders").where("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("l_orderkey"))
    known, unknown = assembly.match_outputs(table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag"), manifest, "l_orderkey")
    both = known.select("l_returnflag", F.lit(1).alias("k")).unionByName(unknown.select("l_returnflag", F.lit(0).alias("k")))
    return both.groupBy("l_returnflag").agg(F.count_if(F.col("k") == 1).alias("matched"), F.count_if(F.col("k") == 0).alias("unmatched"))


@query("retry_set", "select o_orderstatus, count(*) as n from orders where o_orderkey in (select l_orderkey from lineitem where l_returnflag = 'R' and l_quantity > 45) group by 1")
def retry_set(spark: SparkSession, sf: str) -> DataFrame:
    failed = table(spark, sf, "lineitem").where("l_returnflag = 'R' and l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey"))
    return assembly.retry_set(table(spark, sf, "orders"), failed, "o_orderkey").groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query(
    "identity_overlay",
    """with a as (select document_id, min(publication_year) as y, min(doi) as d from legacy_index group by 1), b as (select legacy_study_id, min(publication_year) as y, min(doi) as d from legacy_index where legacy_study_id is not null group by 1)
    select p.document_id, coalesce(a.y, b.y, p.publication_year) as publication_year, coalesce(a.d, b.d) as doi from publication p left join a using (document_id) left join b using (legacy_study_id)""",
)
def identity_overlay(spark: SparkSession, sf: str) -> DataFrame:
    records = table(spark, sf, "publication").select("document_id", "legacy_study_id", "publication_year", F.lit(None).cast("string").alias("doi"))
    return assembly.overlay_identity(records, table(spark, sf, "legacy_index"), "document_id", "legacy_study_id", ["publication_year", "doi"]).drop("legacy_study_id")


@query(
    "decisions_joined",
    "select coalesce(case when c_acctbal > 5000 then 'accept' when c_acctbal > 0 then 'reject' end, 'open') as state, count(*) as n from customer group by 1",
)
def decisions_joined(spark: SparkSession, sf: str) -> DataFrame:
    decided = F.when(F.col("c_acctbal") > 5000, "accept").otherwise("reject")
    rows = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    decisions = rows.where("c_acctbal > 0").select("c_custkey", "c_name", decided.alias("decision"))
    return assembly.with_decisions(rows, decisions, "c_custkey", ["c_name"], "decision").groupBy(F.coalesce("decision", F.lit("open")).alias("state")).agg(F.count("*").alias("n"))


_RESOLVED = """r as (select document_id, publication_year as y, normalized_title as u from legacy_index),
    j as (select i.document_id, r.document_id is not null as found, r.y is not null and r.y is distinct from i.publication_year as dy, r.u is not null and r.u is distinct from i.normalized_title as du from publication i left join r using (document_id))"""


@query(
    "resolution_status",
    f"""with {_RESOLVED} select document_id, case when not found then 'unresolved' when dy or du then 'changed' else 'unchanged' end as status,
      array_to_string(list_filter([case when du then 'normalized_title' end, case when dy then 'publication_year' end], lambda x: x is not null), ',') as changed from j""",
)
def resolution_status(spark: SparkSession, sf: str) -> DataFrame:
    return _resolved(spark, sf).select("document_id", "status", F.array_join("changed", ",").alias("changed"))


def _resolved(spark: SparkSession, sf: str) -> DataFrame:
    fields = ["publication_year", "normalized_title"]
    return assembly.resolve(table(spark, sf, "publication").select("document_id", *fields), table(spark, sf, "legacy_index"), "document_id", fields)


@query("repair_summary", f"with {_RESOLVED}, c as (select case when du then 'normalized_title' end as f from j union all select case when dy then 'publication_year' end from j) select coalesce(f, '') as field, count(*) as n from c where f is not null group by 1")
def repair_summary(spark: SparkSession, sf: str) -> DataFrame:
    return _resolved(spark, sf).select(F.explode("changed").alias("field")).groupBy("field").agg(F.count("*").alias("n"))


@query("manifest_order", "select c_custkey, c_name, row_number() over (order by c_acctbal desc, c_custkey) as position from customer order by position limit 50")
def manifest_order(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer").select("c_custkey", "c_name")
    listed = table(spark, sf, "customer").select(F.struct((-F.col("c_acctbal")).alias("b"), "c_custkey").alias("o")).orderBy("o").limit(50)
    manifest = listed.agg(F.array_sort(F.collect_list("o")).alias("a")).select(F.posexplode("a").alias("p", "o")).select("o.c_custkey", (F.col("p") + 1).cast("bigint").alias("position"))
    return assembly.in_order(rows, manifest, "c_custkey", "position").orderBy("position")


@query("list_values_top", "select value, n from (select unnest(authors) as value, count(*) as n from (select candidate_id, list_distinct(authors) as authors from pubmed_candidate) group by 1) order by n desc, value limit 25")
def list_values_top(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.multivalue_counts(table(spark, sf, "pubmed_candidate"), "candidate_id", F.col("authors")).orderBy(F.desc("n"), "value").limit(25)


@query(
    "filename_topics",
    """with n as (select distinct link_id, 'x/topic-' || slug || '-page-' || right(link_id, 1) || '.csv' as f, slug from document_ontology_link l join ontology_entity e using (entity_id))
    select array_to_string([upper(w[1]) || w[2:] for w in string_split(replace(slug, '-', ' ') || ' studies', ' ')], ' ') as value, count(*) as n from n group by 1""",
)
def filename_topics(spark: SparkSession, sf: str) -> DataFrame:
    """Topics in names of files made of the links of entities."""
    entity = table(spark, sf, "ontology_entity").select("entity_id", "slug")
    rows = table(spark, sf, "document_ontology_link").select("link_id", "entity_id").distinct().join(F.broadcast(entity), "entity_id")  # a fixed table
    name = F.concat(F.lit("x/topic-"), "slug", F.lit("-page-"), F.substring("link_id", -1, 1), F.lit(".csv"))
    return aggregates.multivalue_counts(rows, "link_id", aggregates.topics_of_names(F.array(name), "topic-", "-page-", " studies"))


@query(
    "access_report",
    """with s as (select distinct * from source_candidate) select count(distinct document_id) as documents, count(distinct case when source_text_path is not null then document_id end) as documents_with_text,
      count(distinct case when lower(trim(source_strategy)) in ('pmc_nxml', 'pmc_oai') then document_id end) as documents_open, count(*) filter (where coalesce(extracted_text_chars, 0) <= 0) as failed from s""",
)
def access_report(spark: SparkSession, sf: str) -> DataFrame:
    """Sets of documents by one shuffle on the document, instead of one for each distinct count."""
    rows = table(spark, sf, "source_candidate").distinct()
    flags = rows.groupBy("document_id").agg(F.max(F.col("source_text_path").isNotNull()).alias("t"), F.max(F.lower(F.trim("source_strategy")).isin("pmc_nxml", "pmc_oai")).alias("o"), F.count_if(F.coalesce("extracted_text_chars", F.lit(0)) <= 0).alias("f"))
    return flags.agg(F.count("document_id").alias("documents"), F.count_if("t").alias("documents_with_text"), F.count_if("o").alias("documents_open"), F.sum("f").alias("failed"))


@query(
    "access_progress",
    " union all ".join(
        f"select '{n}' as name, count(*) filter (where document_id in (select document_id from {t})) as members, count(*) as total, round(100.0 * count(*) filter (where document_id in (select document_id from {t})) / count(*), 2) as percent from (select distinct document_id from publication)"
        for n, t in (("indexed", "legacy_index"), ("fetched", "source_candidate"), ("in_corpus", "corpus_record"))
    ),
)
def access_progress(spark: SparkSession, sf: str) -> DataFrame:
    sets = {n: table(spark, sf, t).select("document_id") for n, t in (("indexed", "legacy_index"), ("fetched", "source_candidate"), ("in_corpus", "corpus_record"))}
    return aggregates.membership(table(spark, sf, "publication").select("document_id"), "document_id", sets)


_REASONS = {"no_text": "extracted_text_chars is null or extracted_text_chars <= 0", "short": "extracted_text_chars between 1 and 1999", "no_sections": "coalesce(scientific_section_hit_count, 0) < 2", "no_path": "source_text_path is null"}


@query(
    "quality_reasons",
    "with s as (select distinct * from source_candidate), r as (" + " union all ".join(f"select '{n}' as reason from s where {c}" for n, c in _REASONS.items())
    + " union all select 'none' from s where not (" + " or ".join(f"coalesce({c}, false)" for c in _REASONS.values()) + ")) select reason, count(*) as n from r group by 1",
)
def quality_reasons(spark: SparkSession, sf: str) -> DataFrame:
    reasons = F.array_compact(F.array(*[F.when(F.expr(c), F.lit(n)) for n, c in _REASONS.items()]))
    return aggregates.reason_counts(table(spark, sf, "source_candidate").distinct(), reasons)


_PREDICTED = "case when n_chars >= 1500 then 'long' when n_chars >= 800 then 'middle' else 'short' end"
_REFERENCE = "case when length(text) >= 1400 then 'long' when length(text) >= 900 then 'middle' when text is not null then 'short' end"


@query(
    "classifier_summary",
    f"""with p as (select {_PREDICTED} as a, {_REFERENCE} as b from documents), q as (select * from p where a is not null and b is not null), l as (select a as x from q union select b from q),
    f as (select x, 2.0 * (select count(*) from q where a = x and b = x) / nullif((select count(*) from q where a = x) + (select count(*) from q where b = x), 0) as f1 from l)
    select (select count(*) from q) as rows, (select count(*) from q where a = b) as correct, round((select count(*) from q where a = b) / cast((select count(*) from q) as double), 4) as accuracy, (select round(avg(round(coalesce(f1, 0), 4)), 4) from f) as macro_f1""",
)
def classifier_summary(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.classifier_summary(table(spark, sf, "documents").select(F.expr(_PREDICTED).alias("a"), F.expr(_REFERENCE).alias("b")), "a", "b")


@query(
    "value_spread",
    "select lang, count(*) as rows, min(n_chars) as least, max(n_chars) as most, round(avg(n_chars), 4) as mean, count(*) filter (where n_chars >= 2000) as in_long, count(*) filter (where n_chars >= 1000 and n_chars < 2000) as in_middle, count(*) filter (where n_chars >= 0 and n_chars < 1000) as in_short from documents group by lang",
)
def value_spread(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.spread(table(spark, sf, "documents"), "lang", F.col("n_chars"), [("long", 2000), ("middle", 1000), ("short", 0)])


@query("usage_summary", "select event_type, count(*) as requests, cast(sum(cast(json_extract_string(props, '$.k') as bigint)) as bigint) as tokens, round(min(value), 4) as least, round(max(value), 4) as most, round(sum(value), 2) as total from events group by 1")
def usage_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens used and latencies, from payloads."""
    tokens = F.from_json("props", "k bigint")["k"]
    return table(spark, sf, "events").groupBy("event_type").agg(F.count("*").alias("requests"), F.sum(tokens).alias("tokens"), F.round(F.min("value"), 4).alias("least"), F.round(F.max("value"), 4).alias("most"), F.round(F.sum("value"), 2).alias("total"))


@query("batch_sizes", "select source, count(*) as requests, cast(sum(length(text)) as bigint) as chars, max(length(text)) as most_chars, cast(floor(coalesce(sum(length(text)), 0) / 4) as bigint) as tokens, floor(coalesce(sum(length(text)), 0) / 4) > 20000 as too_large from documents group by source")
def batch_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.batch_sizes(table(spark, sf, "documents"), "source", F.col("text"), 20_000).withColumn("most_chars", F.col("most_chars").cast("bigint"))


@query(
    "strategy_metrics",
    """with s as (select distinct *, lower(trim(source_strategy)) as strategy from source_candidate) select strategy, count(*) as rows, count(distinct document_id) as documents, round(sum(greatest(coalesce(extracted_text_chars, 0), 0)) / cast(count(distinct document_id) as double), 2) as chars_per_document,
      round(100.0 * count(*) filter (where extracted_text_chars >= 2000) / count(*), 2) as ready_percent from s group by 1""",
)
def strategy_metrics(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "source_candidate").distinct().withColumn("strategy", F.lower(F.trim("source_strategy")))
    by_document = rows.groupBy("strategy", "document_id").agg(F.count("*").alias("n"), F.sum(F.greatest(F.coalesce("extracted_text_chars", F.lit(0)), F.lit(0))).alias("c"), F.count_if(F.col("extracted_text_chars") >= 2000).alias("r"))
    return by_document.groupBy("strategy").agg(F.sum("n").alias("rows"), F.count("document_id").alias("documents"), F.round(F.sum("c") / F.count("document_id"), 2).alias("chars_per_document"), aggregates.percent(F.sum("r"), F.sum("n")).alias("ready_percent"))


@query(
    "reference_coverage",
    """select count(*) as matched, count(i.publication_year) as with_year, count(*) filter (where i.publication_year = p.publication_year) as same_year, count(*) filter (where abs(i.publication_year - p.publication_year) = 1) as next_year,
      count(i.doi) as with_doi, count(*) filter (where p.title_en is not null and i.normalized_title is not null) as with_titles from legacy_index i join publication p using (document_id)""",
)
def reference_coverage(spark: SparkSession, sf: str) -> DataFrame:
    index = table(spark, sf, "legacy_index").select("document_id", F.col("publication_year").alias("y"), "doi", F.col("normalized_title").alias("t"))
    both = index.join(table(spark, sf, "publication").select("document_id", "publication_year", "title_en"), "document_id")
    gap = F.abs(F.col("y") - F.col("publication_year"))
    return both.agg(F.count("*").alias("matched"), F.count("y").alias("with_year"), F.count_if(gap == 0).alias("same_year"), F.count_if(gap == 1).alias("next_year"), F.count("doi").alias("with_doi"), F.count_if(F.col("title_en").isNotNull() & F.col("t").isNotNull()).alias("with_titles"))


_STATE = ("publication", "legacy_index", "source_candidate", "corpus_record")


@query("state_snapshot", " union all ".join(f"select '{t}' as name, count(*) as rows from {t}" for t in _STATE))
def state_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return assembly.snapshot({t: table(spark, sf, t) for t in _STATE})


@query(
    "rerun_worklist",
    """with r as (select document_id, 'no_abstract' as reason from publication where abstract is null union select document_id, 'no_year' from publication where publication_year is null
      union select document_id, 'failed_fetch' from source_candidate where coalesce(extracted_text_chars, 0) <= 0) select document_id, string_agg(reason, ',' order by reason) as reasons from r group by 1""",
)
def rerun_worklist(spark: SparkSession, sf: str) -> DataFrame:
    publication = table(spark, sf, "publication")
    reason = lambda df, name: df.select("document_id", F.lit(name).alias("reason"))
    parts = [reason(publication.where("abstract is null"), "no_abstract"), reason(publication.where("publication_year is null"), "no_year"), reason(table(spark, sf, "source_candidate").where("coalesce(extracted_text_chars, 0) <= 0"), "failed_fetch")]
    return assembly.worklist(parts, "document_id").withColumn("reasons", F.array_join("reasons", ","))


@query(
    "quota_sample",
    """with c as (select count(*) filter (where lang = 'pt') as d, count(*) filter (where coalesce(lang <> 'pt', true)) as o from documents), s as (select least(d, 40 - least(o, 10)) as nd, least(o, 40 - least(d, 40 - least(o, 10))) as no from c),
    r as (select doc_id, source, lang, coalesce(lang = 'pt', false) as direct, row_number() over (partition by coalesce(lang = 'pt', false), source order by doc_id) as turn from documents),
    k as (select *, row_number() over (partition by direct order by turn, source nulls first, doc_id) as place from r) select doc_id, source, lang, direct from k, s where place <= case when direct then nd else no end""",
)
def quota_sample(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").select("doc_id", "source", "lang")
    return windows.quota_sample(rows, F.col("lang") == "pt", "source", [F.asc("doc_id")], 40)


_HOLDOUT = {"BUILDING": 5, "MACHINERY": 4, "FURNITURE": 3}


@query(
    "holdout_sample",
    """with t as (select c_custkey, c_mktsegment, c_nationkey, row_number() over (partition by c_mktsegment, c_nationkey order by sha256(cast(c_custkey as varchar))) as turn from customer),
    p as (select *, row_number() over (partition by c_mktsegment order by turn, c_nationkey, sha256(cast(c_custkey as varchar))) as place from t)
    select c_custkey, c_mktsegment, place from p where place <= case c_mktsegment when 'BUILDING' then 5 when 'MACHINERY' then 4 when 'FURNITURE' then 3 else 0 end""",
)
def holdout_sample(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    return windows.holdout(rows, "c_mktsegment", "c_nationkey", [F.sha2(F.col("c_custkey").cast("string"), 256).asc()], _HOLDOUT).select("c_custkey", "c_mktsegment", F.col("place").cast("bigint").alias("place"))


@query(
    "least_used_first",
    """with d as (select doc_id, source, row_number() over (partition by source order by doc_id) as turn from documents where lang = 'en'), a as (select doc_id, source, 'direct' as reason from d order by turn, source nulls first, doc_id limit 18),
    b as (select doc_id, source, 'contrast' as reason from documents where coalesce(lang <> 'en', true) order by source nulls first, doc_id limit 2) select * from a union all select * from b""",
)
def least_used_first(spark: SparkSession, sf: str) -> DataFrame:
    return windows.least_used_first(table(spark, sf, "documents").select("doc_id", "source", "lang"), F.col("lang") == "en", "source", "doc_id", 20).select("doc_id", "source", "reason")


@query("dense_positions", "select c_custkey, row_number() over (order by c_acctbal, c_custkey) as position from customer")
def dense_positions(spark: SparkSession, sf: str) -> DataFrame:
    """Positions of all customers by balance, numbered within ranges of it, so that no task sorts all."""
    rows = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return windows.ranked(rows, [F.asc("c_acctbal"), F.asc("c_custkey")], F.floor(F.col("c_acctbal") / 500), "position").select("c_custkey", F.col("position").cast("bigint").alias("position"))


@query("most_common_values", "select journal, count(*) as n from documents group by 1 order by n desc, min(doc_id) limit 15")
def most_common_values(spark: SparkSession, sf: str) -> DataFrame:
    return windows.most_common(table(spark, sf, "documents"), "journal", "doc_id", 15)


@query("canary_order", "select candidate_id, priority_score, publication_year from pubmed_candidate order by priority_score desc nulls last, publication_year desc nulls last, candidate_id limit 50")
def canary_order(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "pubmed_candidate").select("candidate_id", "priority_score", "publication_year")
    return rows.orderBy(F.desc_nulls_last("priority_score"), F.desc_nulls_last("publication_year"), "candidate_id").limit(50)


@query("filters_in_all", "select count(*) as n, round(avg(n_chars), 4) as mean from documents where lang in ('en', 'pt') and source in (select source from source_weight where target_share > 0.05)")
def filters_in_all(spark: SparkSession, sf: str) -> DataFrame:
    listed = [r["source"] for r in table(spark, sf, "source_weight").where("target_share > 0.05").limit(1000).collect()]  # a fixed table
    return table(spark, sf, "documents").where(assembly.in_all({"lang": ["en", "pt"], "source": listed, "journal": []})).agg(F.count("*").alias("n"), F.round(F.avg("n_chars"), 4).alias("mean"))


@query(
    "repair_targets",
    """select document_id from (select document_id, bool_or(coalesce(extracted_text_chars, 0) <= 0 and source_text_path is null) as b from source_candidate group by 1) where b""",
)
def repair_targets(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of which some assessed source failed for want of text and path."""
    reason = F.array_compact(F.array(F.when((F.coalesce("extracted_text_chars", F.lit(0)) <= 0) & F.col("source_text_path").isNull(), F.lit("nothing_fetched"))))
    rows = table(spark, sf, "source_candidate").groupBy("document_id").agg(F.collect_set(F.struct(reason.alias("failure_reasons"))).alias("assessments"))
    return assembly.to_repair(rows, "assessments", "failure_reasons", "nothing_fetched").select("document_id")


@query("sample_page", "select document_id from (select distinct document_id, classification_dataset_split from corpus_record) where classification_dataset_split <> 'not_source_ready' order by document_id limit 30 offset 15")
def sample_page(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "corpus_record").where("classification_dataset_split <> 'not_source_ready'").select("document_id").distinct()
    return rows.orderBy("document_id").offset(15).limit(30)


@query("nested_redaction", "select source_candidate_id, 'sha256:' || sha256(source_url) as url, 'sha256:' || sha256(source_text_path) as path, source_strategy from (select distinct * from source_candidate) ")
def nested_redaction(spark: SparkSession, sf: str) -> DataFrame:
    """Addresses and paths hidden wherever they stand in a nested record."""
    rows = table(spark, sf, "source_candidate").distinct().select("source_candidate_id", F.struct("source_strategy", F.array(F.struct(F.col("source_url").alias("url"), F.struct(F.col("source_text_path").alias("path")).alias("stored"))).alias("parts")).alias("r"))
    hidden = rows.select("source_candidate_id", ids.redact_fields(F.col("r"), rows.schema["r"].dataType, {"url", "path"}).alias("r"))
    first = F.element_at("r.parts", 1)
    return hidden.select("source_candidate_id", first["url"].alias("url"), first["stored"]["path"].alias("path"), F.col("r.source_strategy").alias("source_strategy"))


@query("request_redaction", "select doc_id, sha256(text) as sha256, length(text) as chars, substr(text, 1, 20) as shown from documents")
def request_redaction(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", tx.redact(F.col("text"), 20).alias("r")).select("doc_id", "r.sha256", F.col("r.chars").cast("bigint").alias("chars"), F.col("r.text").alias("shown"))


@query("viewer_rows", 'select document_id as "documentId", publication_year as "publicationYear", journal as "journal" from publication')
def viewer_rows(spark: SparkSession, sf: str) -> DataFrame:
    return assembly.camel(table(spark, sf, "publication").select("document_id", "publication_year", "journal"))


@query("payload_records", "select doc_id, sha256(text) as payload_sha256, octet_length(encode(text)) as payload_size_bytes from documents where text is not null")
def payload_records(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").where("text is not null").select("doc_id", *ids.payload_record(F.col("text")))


@query(
    "label_lists",
    """select document_id, string_agg(v, ';' order by v) as labels from (select distinct document_id, coalesce(nullif(canonical_label_en, ''), nullif(canonical_label, '')) as v from document_ontology_link join ontology_entity using (entity_id)) where v is not null group by 1""",
)
def label_lists(spark: SparkSession, sf: str) -> DataFrame:
    entity = table(spark, sf, "ontology_entity").select("entity_id", "canonical_label_en", "canonical_label")
    linked = table(spark, sf, "document_ontology_link").select("document_id", "entity_id").distinct().join(F.broadcast(entity), "entity_id")  # a fixed table
    lists = linked.groupBy("document_id").agg(F.collect_set(F.struct("canonical_label_en", "canonical_label")).alias("e"))
    return lists.select("document_id", F.array_join(F.array_sort(tx.label_list(F.col("e"), "canonical_label_en", "canonical_label")), ";").alias("labels"))


@query(
    "rules_prefix",
    """with t as (select doc_id, case when doc_id % 2 = 0 then repeat('word ', 500) || 'references ' || text else text end as x, doc_id % 3 = 0 as h from documents where text is not null),
    n as (select doc_id, h, substr(trim(regexp_replace(x, '[\\s\\p{Z}\\x{0085}]+', ' ', 'g')), 1, 250000) as x from t), p as (select *, nullif(strpos(substr(lower(x), 2001), ' references '), 0) as r from n)
    select doc_id, case when h or r is null then length(x) else 1999 + r end as chars from p""",
)
def rules_prefix(spark: SparkSession, sf: str) -> DataFrame:
    listed = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("word " * 500 + "references "), "text")).otherwise(F.col("text"))
    cut = evidence.rules_prefix(listed, F.col("doc_id") % 3 == 0)
    return table(spark, sf, "documents").where("text is not null").select("doc_id", F.length(cut).cast("bigint").alias("chars"))


@query(
    "all_title_rules",
    """with t as (select document_id, ' ' || trim(regexp_replace(lower(title_en), '[^a-z0-9]+', ' ', 'g')) || ' ' as p from publication where title_en is not null)
    select array_to_string(list_filter([case when contains(p, ' trial ') then 'trial' end, case when contains(p, ' insomnia ') or contains(p, ' sleep ') then 'sleep' end, case when contains(p, ' older adults ') then 'older' end], lambda x: x is not null), '+') as rules, count(*) as n from t group by 1""",
)
def all_title_rules(spark: SparkSession, sf: str) -> DataFrame:
    rules = [("trial", ["trial"]), ("sleep", ["insomnia", "sleep"]), ("older", ["older adults"])]
    return table(spark, sf, "publication").where("title_en is not null").groupBy(F.array_join(evidence.all_rules(F.col("title_en"), rules), "+").alias("rules")).agg(F.count("*").alias("n"))


@query(
    "guardrail_states",
    """with r as (select distinct document_id, medical_condition_labels as a, cannabinoid_labels as b from corpus_record) select case when len(coalesce(a, [])) = 0 and len(coalesce(b, [])) = 0 then 'both_empty' when len(coalesce(b, [])) = 0 then 'candidate_only'
      when len(coalesce(a, [])) = 0 then 'baseline_only' when len(list_filter(a, lambda x: not list_contains(b, x))) = 0 and len(list_filter(b, lambda x: not list_contains(a, x))) = 0 then 'agree' when list_has_any(a, b) then 'overlap' else 'disagree' end as state, count(*) as n from r group by 1""",
)
def guardrail_states(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "corpus_record").select("document_id", "medical_condition_labels", "cannabinoid_labels").distinct()
    return rows.groupBy(evidence.guardrail_states(F.col("medical_condition_labels"), F.col("cannabinoid_labels")).alias("state")).agg(F.count("*").alias("n"))


@query("label_evidence")
def label_evidence(spark: SparkSession, sf: str) -> DataFrame:
    """Sentences of the abstracts that show the labels of their publication's corpus record, with their places."""
    labels = table(spark, sf, "corpus_record").groupBy("document_id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.concat("medical_condition_labels", "cannabinoid_labels"))))).alias("labels"))
    rows = table(spark, sf, "publication").select("document_id", "abstract").join(labels, "document_id")
    return rows.select("document_id", F.explode(evidence.locate_labels(F.col("abstract"), F.col("labels"))).alias("e")).select("document_id", "e.*")


@query(
    "outcome_sentences",
    r"""with s as (select doc_id, unnest(list_distinct(regexp_extract_all(text, '[^.!?]{20,700}[.!?]'))) as t from documents), h as (select doc_id, len(regexp_extract_all(t, '(?i)\b(?:pain|sleep|dose)')) as hits from s)
    select doc_id, count(*) filter (where hits > 0) as with_hits, max(hits) as most from h group by 1 having max(hits) > 0""",
)
def outcome_sentences(spark: SparkSession, sf: str) -> DataFrame:
    """The four sentences of each document that speak most of outcomes; counted over all different sentences."""
    rows = table(spark, sf, "documents").select("doc_id", tx.sentence_spans("text").alias("s"))
    best = rows.withColumn("b", evidence.best_sentences(F.col("s"), [r"\b(?:pain|sleep|dose)"], r"\b(?:results?|conclusions?)\b", most=1_000_000))
    each = best.select("doc_id", F.explode("b").alias("b")).select("doc_id", F.col("b.text").alias("t"), F.col("b.hits").alias("hits")).distinct()
    return each.groupBy("doc_id").agg(F.count("*").alias("with_hits"), F.max("hits").cast("bigint").alias("most"))


@query(
    "preferred_artifact",
    """with s as (select distinct document_id, source_candidate_id, source_text_path, extracted_text_chars, lower(trim(source_strategy)) as st from source_candidate)
    select document_id, source_candidate_id from (select *, row_number() over (partition by document_id order by case when st in ('pmc_nxml', 'pmc_oai') then 0 else 1 end, coalesce(extracted_text_chars, -1) desc, source_candidate_id) as n from s where source_text_path is not null and extracted_text_chars > 0) where n = 1""",
)
def preferred_artifact(spark: SparkSession, sf: str) -> DataFrame:
    """Of the sources with text the one of the preferred format, then the longest."""
    rows = table(spark, sf, "source_candidate").where("source_text_path is not null and extracted_text_chars > 0").select("document_id", "source_candidate_id", "extracted_text_chars", F.lower(F.trim("source_strategy")).alias("st"))
    liked = F.coalesce(F.col("st").isin("pmc_nxml", "pmc_oai"), F.lit(False))
    return windows.best_per_key(rows, ["document_id"], [liked.alias("liked"), F.col("extracted_text_chars"), (-F.col("source_candidate_id")).alias("tie")]).select("document_id", "source_candidate_id")


@query(
    "sources_union",
    """with u as (select 0 as ordinal, 'index' as origin, document_id, publication_year from legacy_index union all select 1, 'study', document_id, publication_year from legacy_study where document_id is not null)
    select document_id, min_by(origin, ordinal) as origin, count(*) as rows from u group by document_id""",
)
def sources_union(spark: SparkSession, sf: str) -> DataFrame:
    both = assembly.sources_union([("index", table(spark, sf, "legacy_index").select("document_id", "publication_year")), ("study", table(spark, sf, "legacy_study").where("document_id is not null").select("document_id", "publication_year"))])
    return both.groupBy("document_id").agg(F.min_by("origin", "ordinal").alias("origin"), F.count("*").alias("rows"))


#: Queries that make up the report on the state of a collection.
STATUS = ("state_snapshot", "access_report", "access_progress", "quality_reasons", "strategy_metrics", "reference_coverage", "resolution_summary", "classifier_summary", "list_values_top")


@query("resolution_summary", f"with {_RESOLVED} select case when not found then 'unresolved' when dy or du then 'changed' else 'unchanged' end as status, count(*) as n from j group by 1")
def resolution_summary(spark: SparkSession, sf: str) -> DataFrame:
    return _resolved(spark, sf).groupBy("status").agg(F.count("*").alias("n"))


def base_status(spark: SparkSession, sf: str, most: int = 1_000) -> dict[str, list[dict]]:
    """The report: rows of each of its queries, which are aggregates; ValueError if one has more than most."""
    return {name: [r.asDict(recursive=True) for r in fixed_size(QUERIES[name](spark, sf), most, name)] for name in STATUS}
