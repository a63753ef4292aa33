"""Aggregation, samples, merges and event windows over records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litscout.functions import text as tx
from litscout.operators import aggregates, joins, merge, windows
from litscout.session import table
from litscout.streaming import events as stream

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


@query("json_props", "select event_type, cast(sum(cast(json_extract_string(props, '$.k') as bigint)) as bigint) as total from events group by 1")
def json_props(spark: SparkSession, sf: str) -> DataFrame:
    held = F.from_json("props", "k bigint")["k"]
    return table(spark, sf, "events").groupBy("event_type").agg(F.sum(held).alias("total"))


@query(
    "month_windows",
    "select greatest(date_trunc('month', o_orderdate), timestamp '1995-01-10') as start, least(last_day(o_orderdate), date '1996-11-20') as until, count(*) as n from orders where o_orderdate between timestamp '1995-01-10' and timestamp '1996-11-20' group by 1, 2",
)
def month_windows(spark: SparkSession, sf: str) -> DataFrame:
    low, high = F.lit("1995-01-10").cast("timestamp_ntz"), F.lit("1996-11-20").cast("timestamp_ntz")
    rows = table(spark, sf, "orders").where(F.col("o_orderdate").between(low, high))
    start, end = F.greatest(F.date_trunc("month", "o_orderdate").cast("timestamp_ntz"), low), F.least(F.last_day("o_orderdate"), F.lit("1996-11-20").cast("date"))
    return rows.groupBy(start.alias("start"), end.alias("until")).agg(F.count("*").alias("n"))


@query("status_pivot", "select o_orderpriority, count(*) filter (where o_orderstatus = 'O') as o, count(*) filter (where o_orderstatus = 'F') as f, count(*) filter (where o_orderstatus = 'P') as p from orders group by 1")
def status_pivot(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.pivot_counts(table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus", ["O", "F", "P"])


@query("crosstab", "select lang, source, count(*) as n from documents group by 1, 2")
def crosstab(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.crosstab(table(spark, sf, "documents"), "lang", "source")


@query(
    "multivalue_groupby",
    "select value, count(*) as n from (select distinct document_id, unnest(list_distinct([regexp_replace(trim(lower(x)), '\\s+', ' ', 'g') for x in medical_condition_labels])) as value from (select distinct document_id, medical_condition_labels from corpus_record)) where value is not null group by 1",
)
def multivalue_groupby(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "corpus_record").select("document_id", "medical_condition_labels").distinct()
    return aggregates.multivalue_counts(rows, "document_id", F.transform("medical_condition_labels", tx.condition_key))


@query(
    "document_rollup",
    """with c as (select l_orderkey, l_returnflag, count(*) as n from lineitem group by 1, 2),
    b as (select l_orderkey, l_linenumber, row_number() over (partition by l_orderkey order by l_extendedprice desc, l_linenumber) as r from lineitem)
    select c.l_orderkey, cast(sum(c.n) as bigint) as total, string_agg(l_returnflag || '=' || n, ';' order by l_returnflag || '=' || n) as flags, min(b.l_linenumber) as best_line,
      case when bool_or(l_returnflag = 'R') then 'returned' when bool_or(l_returnflag = 'A') then 'accepted' else 'open' end as decision
    from c join b on b.l_orderkey = c.l_orderkey and b.r = 1 group by c.l_orderkey""",
)
def document_rollup(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    counts = aggregates.map_rollup(lines, "l_orderkey", "l_returnflag").withColumnRenamed("by", "flags")
    best = lines.groupBy("l_orderkey").agg(F.max_by("l_linenumber", F.struct("l_extendedprice", -F.col("l_linenumber"))).alias("best_line"))
    decision = F.when(F.col("flags").contains("R="), "returned").when(F.col("flags").contains("A="), "accepted").otherwise("open")
    return counts.join(best, "l_orderkey").withColumn("decision", decision)


_PREDICTED = "case when n_chars >= 1500 then 'long' when n_chars >= 800 then 'middle' else 'short' end"
_REFERENCE = "case when length(text) >= 1400 then 'long' when length(text) >= 900 then 'middle' when text is not null then 'short' end"


def _rated(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(F.expr(_PREDICTED).alias("predicted"), F.expr(_REFERENCE).alias("reference"))


@query(
    "classifier_metrics",
    f"""with p as (select {_PREDICTED} as predicted, {_REFERENCE} as reference from documents), c as (select predicted, reference, count(*) as n from p where predicted is not null and reference is not null group by 1, 2),
    l as (select predicted as label from c union select reference from c),
    m as (select label, coalesce(sum(n) filter (where predicted = label and reference = label), 0) as tp, coalesce(sum(n) filter (where predicted = label and reference <> label), 0) as fp,
      coalesce(sum(n) filter (where reference = label and predicted <> label), 0) as fn from l cross join c group by label)
    select label, cast(tp as bigint) as tp, cast(fp as bigint) as fp, cast(fn as bigint) as fn, case when tp + fp > 0 then round(tp / cast(tp + fp as double), 4) end as precision,
      case when tp + fn > 0 then round(tp / cast(tp + fn as double), 4) end as recall, coalesce(round(2 * tp / cast(nullif(2 * tp + fp + fn, 0) as double), 4), 0.0) as f1 from m""",
)
def classifier_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.classifier_metrics(_rated(spark, sf), "predicted", "reference")


@query("error_patterns", f"select predicted, reference, count(*) as n from (select {_PREDICTED} as predicted, {_REFERENCE} as reference from documents) where predicted <> reference group by 1, 2")
def error_patterns(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.confusion_errors(_rated(spark, sf), "predicted", "reference")


@query("latest_decision", "select user_id, event_id, event_type from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as n from events) where n = 1")
def latest_decision(spark: SparkSession, sf: str) -> DataFrame:
    return windows.best_per_key(table(spark, sf, "events").select("user_id", "event_id", "event_type", "ts"), ["user_id"], [F.col("ts"), F.col("event_id")]).select("user_id", "event_id", "event_type")


@query("top_per_group", "select c_mktsegment, c_custkey, c_acctbal from (select *, row_number() over (partition by c_mktsegment order by c_acctbal desc, c_custkey) as n from customer) where n <= 3")
def top_per_group(spark: SparkSession, sf: str) -> DataFrame:
    return windows.top_n(table(spark, sf, "customer").select("c_mktsegment", "c_custkey", "c_acctbal"), ["c_mktsegment"], [F.desc("c_acctbal"), F.asc("c_custkey")], 3)


@query("round_robin", "select c_custkey, c_mktsegment from (select *, row_number() over (partition by c_mktsegment order by c_custkey) as turn from customer) order by turn, c_mktsegment limit 40")
def round_robin(spark: SparkSession, sf: str) -> DataFrame:
    return windows.round_robin(table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), "c_mktsegment", [F.asc("c_custkey")], 40).select("c_custkey", "c_mktsegment")


@query("round_robin_hash", "select c_custkey, c_mktsegment from (select *, row_number() over (partition by c_mktsegment order by sha256(cast(c_custkey as varchar))) as turn from customer) order by turn, c_mktsegment limit 40")
def round_robin_hash(spark: SparkSession, sf: str) -> DataFrame:
    order = [F.sha2(F.col("c_custkey").cast("string"), 256).asc()]
    return windows.round_robin(table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), "c_mktsegment", order, 40).select("c_custkey", "c_mktsegment")


@query("stratified_sample")
def stratified_sample(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").select("doc_id", "lang", "source", F.lower("text").alias("t"), "n_chars")
    strata = [(f"topic{i}", F.col("t").contains(w)) for i, w in enumerate(("insomnia", "migraine", "glaucoma", "enxaqueca"))] + [(f"lang_{x}", F.col("lang") == x) for x in ("en", "pt", "es")]
    return windows.stratified(rows, strata, [(-F.col("n_chars")).alias("o"), F.col("doc_id").alias("k")], "doc_id", 20).select("doc_id", "rank")


@query("first_wins_dedupe", "select hash, min(doc_id) as doc_id from (select md5(trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g'))) as hash, doc_id from documents where text is not null) group by 1")
def first_wins_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").where("text is not null").select(F.md5(tx.lookup_text(F.col("text"))).alias("hash"), "doc_id")
    return windows.first_wins(rows, ["hash"], "doc_id")


@query(
    "queue_list",
    "select o_orderkey, c_name, coalesce(n, 0) as lines from orders join customer on c_custkey = o_custkey left join (select l_orderkey, count(*) as n from lineitem group by 1) on l_orderkey = o_orderkey "
    "order by case o_orderstatus when 'O' then 0 when 'P' then 1 else 2 end, o_totalprice desc, o_orderdate, o_orderkey limit 100",
)
def queue_list(spark: SparkSession, sf: str) -> DataFrame:
    rank = F.when(F.col("o_orderstatus") == "O", 0).when(F.col("o_orderstatus") == "P", 1).otherwise(2)
    # The page is cut before the lines are counted: only its orders are joined with lineitem.
    chosen = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("c_custkey") == F.col("o_custkey")).orderBy(rank, F.desc("o_totalprice"), "o_orderdate", "o_orderkey").limit(100).select("o_orderkey", "c_name")
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return chosen.join(lines.withColumn("one", F.lit(1)), "o_orderkey", "left").groupBy("o_orderkey", "c_name").agg(F.count("one").alias("lines"))


@query("left_multi_on", "select o_orderkey, count(l_linenumber) as n from orders left join lineitem on l_orderkey = o_orderkey and l_returnflag in ('R', 'A') and l_quantity > 30 group by 1")
def left_multi_on(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    joined = joins.left_where(table(spark, sf, "orders").select("o_orderkey"), lines, "o_orderkey", F.col("l_returnflag").isin("R", "A") & (F.col("l_quantity") > 30))
    return joined.groupBy("o_orderkey").agg(F.count("l_linenumber").alias("n"))


@query("not_exists", "select c_custkey from customer where not exists (select 1 from orders where o_custkey = c_custkey and o_orderstatus = 'P')")
def not_exists(spark: SparkSession, sf: str) -> DataFrame:
    open_orders = table(spark, sf, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf, "customer").select("c_custkey").join(open_orders, "c_custkey", "left_anti")


@query("set_difference", "select 'only_publication' as side, count(*) as n from (select document_id from publication except select document_id from legacy_index) union all select 'both', count(*) from (select document_id from publication intersect select document_id from legacy_index)")
def set_difference(spark: SparkSession, sf: str) -> DataFrame:
    a, b = table(spark, sf, "publication").select("document_id"), table(spark, sf, "legacy_index").select("document_id")
    count = lambda df, side: df.agg(F.count("*").alias("n")).select(F.lit(side).alias("side"), "n")
    return count(a.subtract(b), "only_publication").unionByName(count(a.intersect(b), "both"))


@query(
    "merge_upsert",
    """with o as (select user_id, max_by(event_type, event_id) as event_type, min(event_id) as first_id from events where event_id % 2 = 0 group by 1), n as (select user_id, max_by(event_type, event_id) as event_type, min(event_id) as first_id from events where event_id % 2 = 1 group by 1)
    select coalesce(n.user_id, o.user_id) as user_id, coalesce(n.event_type, o.event_type) as event_type, coalesce(o.first_id, n.first_id) as first_id from o full join n using (user_id)""",
)
def merge_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Two halves of the events as an old and a new state; first_id is kept as it was."""
    state = lambda rest: table(spark, sf, "events").where(F.col("event_id") % 2 == rest).groupBy("user_id").agg(F.max_by("event_type", "event_id").alias("event_type"), F.min("event_id").alias("first_id"))
    return merge.upsert(state(0), state(1), ["user_id"], preserve=["first_id"])


@query("history_fold", "select user_id, count(*) as entries, string_agg(event_type, '>' order by ts, event_id) as history from events group by user_id")
def history_fold(spark: SparkSession, sf: str) -> DataFrame:
    return merge.fold_history(table(spark, sf, "events"), "user_id", ["ts", "event_id"], F.col("event_type")).withColumn("entries", F.col("entries").cast("bigint"))


@query("first_seen", "select pmid, min(candidate_id) as first, string_agg(distinct cannabinoid_focus, '+' order by cannabinoid_focus) as labels from pubmed_candidate where pmid is not null group by pmid")
def first_seen(spark: SparkSession, sf: str) -> DataFrame:
    return merge.first_seen(table(spark, sf, "pubmed_candidate").where("pmid is not null"), "pmid", "candidate_id", "cannabinoid_focus")


@query("events_tumbling", "select date_trunc('hour', ts) as start, event_type, count(*) as n, round(sum(value), 4) as total from events group by 1, 2")
def events_tumbling(spark: SparkSession, sf: str) -> DataFrame:
    out = stream.tumbling(stream.timed(table(spark, sf, "events")))
    return out.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


@query(
    "events_sessions",
    """with g as (select user_id, ts, case when ts - lag(ts) over (partition by user_id order by ts, event_id) < interval 30 minute then 0 else 1 end as fresh from events),
    s as (select user_id, ts, sum(fresh) over (partition by user_id order by ts rows unbounded preceding) as k from g) select user_id, min(ts) as start, count(*) as n from s group by user_id, k""",
)
def events_sessions(spark: SparkSession, sf: str) -> DataFrame:
    return stream.sessions(stream.timed(table(spark, sf, "events"))).select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), "n")


@query("links_by_entity", "select entity_id, count(*) as links, count(distinct document_id) as documents, round(avg(confidence), 3) as mean_confidence from (select distinct * from document_ontology_link) group by entity_id")
def links_by_entity(spark: SparkSession, sf: str) -> DataFrame:
    """One entity holds a tenth of the rows: both distinct steps combine before the shuffle, by document within an entity."""
    links = table(spark, sf, "document_ontology_link").distinct()
    by_document = links.groupBy("entity_id", "document_id").agg(F.count("*").alias("n"), F.sum("confidence").alias("s"), F.count("confidence").alias("c"))
    return by_document.groupBy("entity_id").agg(F.sum("n").alias("links"), F.count("*").alias("documents"), F.round(F.sum("s") / F.sum("c"), 3).alias("mean_confidence"))
