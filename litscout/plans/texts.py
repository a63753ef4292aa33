"""Normalisers, extraction, grounding and scores over texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litscout.functions import text as tx
from litscout.operators import evidence, index, joins
from litscout.session import fixed_size, table

QUERIES, ORACLES = {}, {}
TERMS = ["insomnia", "migraine", "glaucoma", "obesity", "psoriasis"]
RULES = [("review", ["scoping review", "systematic review"]), ("meta", ["meta analysis"]), ("case", ["case report"]), ("animal", ["animal study"]), ("lab", ["laboratory study"]), ("trial", ["controlled trial", "open label trial"])]
ROUTES = {"population": "participants|patients|volunteers", "outcome": "adverse effects|side effects", "design": "randomised|cohort|survey"}
ALLOWED, RENAMED = ["click", "view", "purchase"], {"buy": "purchase"}
MAX_QUOTES = 2_000


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


@query("match_key_norm", "select distinct canonical_label || ' (ABC)' as label, trim(regexp_replace(lower(strip_accents(canonical_label)), '[^a-z0-9]+', ' ', 'g')) as key from ontology_entity")
def match_key_norm(spark: SparkSession, sf: str) -> DataFrame:
    labels = table(spark, sf, "ontology_entity").select(F.concat("canonical_label", F.lit(" (ABC)")).alias("label")).distinct()
    return labels.select("label", tx.match_key(F.col("label")).alias("key"))


@query("title_norm", "select document_id, nullif(trim(regexp_replace(lower(strip_accents(title_en)), '[^a-z0-9]+', ' ', 'g')), '') as title from publication")
def title_norm(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "publication").select("document_id", tx.normalize_title(F.col("title_en")).alias("title"))


@query("lookup_text_norm", "select doc_id, length(trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g'))) as chars, md5(trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g'))) as hash from documents")
def lookup_text_norm(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").select("doc_id", tx.lookup_text(F.col("text")).alias("t"))
    return rows.select("doc_id", F.length("t").cast("bigint").alias("chars"), F.md5("t").alias("hash"))


@query("study_type_keys", "select regexp_replace(trim(replace(lower(strip_accents(legacy_study_type)), '-', ' ')), '\\s+', ' ', 'g') as study_type, count(*) as n from corpus_record group by 1")
def study_type_keys(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "corpus_record").groupBy(tx.study_type_key(F.col("legacy_study_type")).alias("study_type")).agg(F.count("*").alias("n"))


@query("visible_text")
def visible_text(spark: SparkSession, sf: str) -> DataFrame:
    """Markup put around all documents and taken off again; a null text has a null hash. Entities and blanks of all kinds are more
    than SQL can follow; tests compare with brute force."""
    marked = F.concat(F.lit("<p>"), F.replace(F.col("text"), F.lit("\n"), F.lit("</p><p>")), F.lit("</p><script>x</script>"))
    return table(spark, sf, "documents").select("doc_id", F.md5(tx.visible_text(marked)).alias("hash"))


@query(
    "term_hits",
    "with h as (select " + " + ".join(f"(case when contains(lower(coalesce(text, '')), '{t}') then 1 else 0 end)" for t in TERMS) + " as hits, coalesce(n_chars, 0) as chars from documents) "
    "select case when chars >= 1000 and hits >= 1 then 'strict' when chars >= 1000 then 'broad' else 'not_ready' end as split, hits, count(*) as n from h group by 1, 2",
)
def term_hits(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").select(tx.term_hits(F.col("text"), TERMS).alias("hits"), F.coalesce("n_chars", F.lit(0)).alias("chars"))
    split = F.when((F.col("chars") >= 1000) & (F.col("hits") >= 1), "strict").when(F.col("chars") >= 1000, "broad").otherwise("not_ready")
    return rows.groupBy(split.alias("split"), "hits").agg(F.count("*").alias("n"))


@query("token_estimates", "select lang, count(*) as n, cast(sum(greatest(1, cast(ceil(length(text) / 4.0) as bigint))) as bigint) as tokens from documents where text is not null group by lang")
def token_estimates(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").where("text is not null").groupBy("lang").agg(F.count("*").alias("n"), F.sum(tx.token_estimate(F.col("text"))).alias("tokens"))


@query(
    "title_rules",
    "with t as (select document_id, ' ' || trim(regexp_replace(lower(title_en), '[^a-z0-9]+', ' ', 'g')) || ' ' as p from publication) select document_id, "
    + "case " + " ".join("when " + " or ".join(f"contains(p, ' {x} ')" for x in phrases) + f" then '{name}'" for name, phrases in RULES) + " end as rule from t",
)
def title_rules(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "publication").select("document_id", evidence.first_rule(F.col("title_en"), RULES).alias("rule"))


@query(
    "field_router",
    " union all ".join(f"select '{n}' as field, count(*) filter (where regexp_matches(lower(text), '{p}')) as supported, count(*) filter (where text is null or not regexp_matches(lower(text), '{p}')) as insufficient from documents" for n, p in ROUTES.items()),
)
def field_router(spark: SparkSession, sf: str) -> DataFrame:
    """All fields in one pass over the texts."""
    low = F.lower("text")
    counts = table(spark, sf, "documents").agg(*[F.struct(F.count_if(low.rlike(p)).alias("supported"), F.count_if(F.coalesce(~low.rlike(p), F.lit(True))).alias("insufficient")).alias(n) for n, p in ROUTES.items()])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(n).alias("field"), F.col(f"{n}.supported").alias("supported"), F.col(f"{n}.insufficient").alias("insufficient")) for n in ROUTES])).alias("r")).select("r.*")


@query("sample_sizes")
def sample_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", F.explode(evidence.sample_sizes("text")).alias("s")).select("doc_id", "s.*")


@query(
    "sentence_spans",
    r"""with s as (select doc_id, unnest(regexp_extract_all(text, '[^.!?]{20,700}[.!?]')) as t from documents) select doc_id, count(*) as sentences, cast(sum(length(t)) as bigint) as chars,
      md5(string_agg(regexp_replace(t, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g'), '|' order by regexp_replace(t, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g'))) as hash from s group by doc_id""",
)
def sentence_spans(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").select("doc_id", F.explode(tx.sentence_spans("text")).alias("s"))
    joined = F.array_join(F.array_sort(F.collect_list("s.text")), "|")
    return rows.groupBy("doc_id").agg(F.count("*").alias("sentences"), F.sum(F.col("s.char_end") - F.col("s.char_start")).alias("chars"), F.md5(joined).alias("hash"))


@query("evidence_around")
def evidence_around(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", evidence.around(F.col("text"), r"\d+ weeks").alias("evidence")).where("evidence is not null")


_LIST = "' ' || repeat('word ', 1100) || 'references ' || text"


@query(
    "references_cut",
    f"""with t as (select doc_id, case when doc_id % 2 = 0 then text || {_LIST} else text || ' bibliography ' || text end as text from documents),
    p as (select doc_id, text, nullif(strpos(substr(lower(text), 5001), ' references '), 0) as r, nullif(strpos(substr(lower(text), 5001), ' bibliography '), 0) as b from t)
    select doc_id, length(text) as given, md5(case when coalesce(r, b) is null then text else substr(text, 1, 4999 + coalesce(r, b)) end) as hash from p""",
)
def references_cut(spark: SparkSession, sf: str) -> DataFrame:
    """All documents, each with a list of references put behind it, cut at the list if that starts late enough."""
    long = F.concat("text", F.lit(" " + "word " * 1100 + "references "), "text")
    listed = F.when(F.col("doc_id") % 2 == 0, long).otherwise(F.concat("text", F.lit(" bibliography "), "text"))
    rows = table(spark, sf, "documents").select("doc_id", listed.alias("text"))
    return rows.select("doc_id", F.length("text").cast("bigint").alias("given"), F.md5(evidence.cut_references(F.col("text"), most=None)).alias("hash"))


@query(
    "grounding_exact",
    """with q as (select item_id, trim(regexp_replace(lower(regexp_extract(text, '^([^.]+)', 1)), '[^a-z0-9]+', ' ', 'g')) as e from benchmark), d as (select doc_id, trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')) as s from documents)
    select item_id, count(*) as documents from q join d on contains(s, e) where e <> '' group by item_id""",
)
def grounding_exact(spark: SparkSession, sf: str) -> DataFrame:
    """In how many documents the first sentence of each held-out item stands: a fixed set of quotes, checked in its size, tested
    in one pass over the documents, without joining each with each."""
    rows = fixed_size(table(spark, sf, "benchmark").select("item_id", tx.lookup_text(F.regexp_extract("text", r"^([^.]+)", 1)).alias("e")), MAX_QUOTES, "benchmark")
    quotes = F.array(*[F.struct(F.lit(r["item_id"]).alias("item_id"), F.lit(r["e"]).alias("e")) for r in rows if r["e"]])
    texts = table(spark, sf, "documents").select("doc_id", tx.lookup_text(F.col("text")).alias("s"))
    return texts.select("doc_id", F.explode(F.filter(quotes, lambda q: F.col("s").contains(q["e"]))).alias("q")).groupBy("q.item_id").agg(F.count("*").alias("documents"))


_PAIR_SQL = """with p as (select document_id, string_split(trim(regexp_replace(lower(title_en), '[^a-z0-9]+', ' ', 'g')), ' ') as e, string_split(trim(regexp_replace(lower(normalized_title), '[^a-z0-9]+', ' ', 'g')), ' ') as s
    from publication where title_en is not null and normalized_title is not null),
  b as (select document_id, e, s, [e[i] || ' ' || e[i + 1] for i in range(1, len(e))] as eb, [s[i] || ' ' || s[i + 1] for i in range(1, len(s))] as sb from p)
  select document_id, round(len([x for x in eb if list_contains(sb, x)]) / cast(len(eb) as double), 4) as score from b where len(eb) > 0"""


@query("grounding_bigrams", _PAIR_SQL)
def grounding_bigrams(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "publication").where("title_en is not null and normalized_title is not null").select("document_id", tx.lookup_text(F.col("title_en")).alias("e"), tx.lookup_text(F.col("normalized_title")).alias("s"))
    return rows.where(F.col("e").contains(" ")).select("document_id", F.round(evidence.grounding_score("e", "s"), 4).alias("score"))


@query(
    "grounding_status",
    r"""with l as (select distinct link_id, document_id, evidence_text from document_ontology_link where evidence_text is not null),
    n as (select link_id, trim(regexp_replace(lower(evidence_text), '[^a-z0-9]+', ' ', 'g')) as e, trim(regexp_replace(lower(concat_ws(' ', title_pt, title_en, abstract)), '[^a-z0-9]+', ' ', 'g')) as s from l join publication p on p.document_id = l.document_id),
    w as (select *, string_split(e, ' ') as ew, string_split(s, ' ') as sw, e <> '' and contains(s, e) as exact from n),
    b as (select *, [ew[i] || ' ' || ew[i + 1] for i in range(1, len(ew))] as eb, [sw[i] || ' ' || sw[i + 1] for i in range(1, len(sw))] as sb from w),
    g as (select exact, len(ew) as words, case when exact then 1.0 when len(eb) = 0 then case when e <> '' and list_contains(sw, e) then 1.0 else 0.0 end
      else round(len([x for x in eb if list_contains(sb, x)]) / cast(len(eb) as double), 4) end as score from b)
    select case when exact then 'exact' when words >= 6 and score >= 0.8 then 'tolerant' else 'review' end as status, count(*) as n, round(avg(score), 4) as mean_score from g group by 1""",
)
def grounding_status(spark: SparkSession, sf: str) -> DataFrame:
    """Every ontology link's quoted evidence against the title of its publication."""
    links = table(spark, sf, "document_ontology_link").where("evidence_text is not null").select("document_id", "link_id", "evidence_text").dropDuplicates(["link_id"])
    titles = table(spark, sf, "publication").select("document_id", F.concat_ws(" ", "title_pt", "title_en", "abstract").alias("source"))
    return links.join(titles, "document_id").select("link_id", evidence.grounding(F.col("evidence_text"), F.col("source")).alias("g")).groupBy("g.status").agg(F.count("*").alias("n"), F.round(F.avg("g.score"), 4).alias("mean_score"))


@query(
    "content_overlap",
    """with w as (select document_id, list_distinct([x for x in string_split(trim(regexp_replace(lower(strip_accents(title_en)), '[^a-z0-9]+', ' ', 'g')), ' ') if length(x) > 2 and x not in ({})]) as a,
      list_distinct([x for x in string_split(trim(regexp_replace(lower(strip_accents(translate(normalized_title, '‐‑–—“”', ''))), '[^a-z0-9]+', ' ', 'g')), ' ') if length(x) > 2 and x not in ({})]) as b
      from publication where title_en is not null and normalized_title is not null)
    select document_id, round(len(list_intersect(a, b)) / cast(least(len(a), len(b)) as double), 4) as overlap from w where least(len(a), len(b)) > 0""".format(*[", ".join(f"'{g}'" for g in joins.GENERIC)] * 2),
)
def content_overlap(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "publication").where("title_en is not null and normalized_title is not null")
    rows = rows.select("document_id", joins.content_tokens(tx.normalize_title(F.col("title_en"))).alias("a"), joins.content_tokens(tx.normalize_title(F.col("normalized_title"))).alias("b"))
    return rows.where(F.least(F.size("a"), F.size("b")) > 0).select("document_id", F.round(joins.overlap(F.col("a"), F.col("b")), 4).alias("overlap"))


@query(
    "weighted_score",
    """with c as (select source_candidate_id, round(least(1.0, greatest(0.0, coalesce(extracted_text_chars, 0) / 6000.0)), 4) as a, round(least(1.0, greatest(0.0, coalesce(scientific_section_hit_count, 0) / 4.0)), 4) as b,
      round(least(1.0, greatest(0.0, coalesce(cannabinoid_term_hit_count, 0) / 8.0)), 4) as c, case when source_text_path is null then 0.15 else 0.0 end as p from (select distinct * from source_candidate)),
    s as (select source_candidate_id, round(least(1.0, greatest(0.0, cast(a as double) * 0.5 + cast(b as double) * 0.25 + cast(c as double) * 0.25 - cast(p as double))), 2) as score from c)
    select score, case when score >= 0.95 then 'high' when score >= 0.75 then 'medium' else 'low' end as band, count(*) as n from s group by 1, 2""",
)
def weighted_score(spark: SparkSession, sf: str) -> DataFrame:
    share = lambda c, most: F.coalesce(F.col(c), F.lit(0)) / most
    parts = {"length": (share("extracted_text_chars", 6000), 0.5), "sections": (share("scientific_section_hit_count", 4), 0.25), "terms": (share("cannabinoid_term_hit_count", 8), 0.25)}
    score = evidence.weighted_score(parts, F.when(F.col("source_text_path").isNull(), 0.15).otherwise(0.0), (("high", 0.95), ("medium", 0.75)))
    rows = table(spark, sf, "source_candidate").distinct().select(F.round(score["score"], 2).alias("score"))
    band = F.when(F.col("score") >= 0.95, "high").when(F.col("score") >= 0.75, "medium").otherwise("low")
    return rows.groupBy("score", band.alias("band")).agg(F.count("*").alias("n"))


@query(
    "schema_repair",
    "select event_type as given, case when event_type = 'buy' then 'purchase' when event_type in ('click', 'view', 'purchase') then event_type end as kept, count(*) as n from events group by 1, 2",
)
def schema_repair(spark: SparkSession, sf: str) -> DataFrame:
    fixed = evidence.repair_values(F.array("event_type"), ALLOWED, RENAMED)
    return table(spark, sf, "events").groupBy(F.col("event_type").alias("given"), F.try_element_at(fixed["kept"], F.lit(1)).alias("kept")).agg(F.count("*").alias("n"))


@query(
    "validation_violations",
    "select violation, count(*) as n from (select unnest(['year', 'abstract', 'language']) as violation, publication_year as y, abstract as a, language as l from publication) "
    "where (violation = 'year' and not coalesce(y between 1900 and 2100, false)) or (violation = 'abstract' and not coalesce(length(a) > 0, false)) or (violation = 'language' and not coalesce(length(trim(l)) between 2 and 5, false)) group by 1",
)
def validation_violations(spark: SparkSession, sf: str) -> DataFrame:
    rules = {"year": F.col("publication_year").between(1900, 2100), "abstract": F.length("abstract") > 0, "language": F.length(F.trim("language")).between(2, 5)}
    return index.validate(table(spark, sf, "publication"), rules)[1].groupBy("violation").agg(F.count("*").alias("n"))
