"""Problem 8: sources mixed to target shares of the total size, in tokens of a public tokenizer.

Method: Pareto order sampling. Of what a source owes to the mixture, whole copies of all its documents are certain; the
rest is a sample of unequal inclusion probabilities, which grow with a document's size to the power GAMMA and are set so
that the expected tokens are those owed. Documents are ranked by their random odds divided by their inclusion odds, and
taken in that order until the tokens are reached. The random number of a document is a hash of its key, so that lost
tasks and reruns give the same sample. The order is cut by a histogram of ranks, so that no task sorts a source.

Without a given total the mixture is the largest in which every listed source that has documents keeps its share within
its max_repeats. Shares of listed sources without documents cannot be reached: they are reported with 0, and the others
keep their proportions.

Defined results: null texts, empty texts and texts of unlisted or null sources are not used. Rows repeated under one
doc_id count once. Shares that are null or not positive, and max_repeats below 1, give nothing. Empty tables give an empty
mixture.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from litscout.session import cut, fixed_size, spread, table

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
MAX_SOURCES = 10_000
GAMMA = 0.5
BUCKETS = 4096
SEED = 20


def with_tokens(docs: DataFrame, text: str, tokenizer: str = TOKENIZER) -> DataFrame:
    """Adds the number of tokens of the whole text in place of it."""
    fields = [f for f in docs.schema.fields if f.name != text]

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from tokenizers import Tokenizer

        encoder = Tokenizer.from_file(tokenizer)
        encoder.encode_special_tokens = True
        for batch in batches:
            texts = batch[text].fillna("").tolist()
            sizes = [len(e) for k in range(0, len(texts), 64) for e in encoder.encode_batch(texts[k : k + 64], add_special_tokens=False)]
            yield batch.drop(columns=[text]).assign(tokens=sizes)

    return docs.mapInPandas(count, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields) + ", tokens bigint")


def plan(wanted: dict[str, tuple[float, int]], have: dict[str, int], total: float | None = None) -> dict[str, dict]:
    """For each source its share among those present, the tokens owed, whole copies and the tokens to be sampled."""
    present = {s: w for s, w in wanted.items() if have.get(s, 0) > 0 and w[0] > 0 and w[1] >= 1}
    scale = sum(share for share, _ in present.values())
    most = min((repeats * have[s] / (share / scale) for s, (share, repeats) in present.items()), default=0.0)
    size = most if total is None else min(total, most)
    out = {}
    for s, (share, repeats) in present.items():
        owed = size * share / scale
        copies = min(repeats, int(owed / have[s] + 1e-9))
        out[s] = {"share": share / scale, "owed": owed, "copies": copies, "rest": max(0.0, owed - copies * have[s]) if copies < repeats else 0.0}
    return out


def _factor(sizes: list[tuple[float, int, int]], rest: float) -> float:
    """c with sum of min(1, c * size^GAMMA) * tokens = rest, from (size, documents, tokens) of size classes."""
    low, high = 0.0, 1.0
    reached = lambda c: sum(min(1.0, c * s**GAMMA) * t for s, _, t in sizes)
    if rest >= sum(t for *_, t in sizes):
        return 1e9
    while reached(high) < rest:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if reached(middle) < rest else (low, middle)
    return high


def mix(docs: DataFrame, wanted: dict[str, tuple[float, int]], total: float | None = None) -> tuple[DataFrame, dict[str, dict]]:
    """(doc_id, source, tokens, copies) of the documents used, and the plan. docs: (doc_id, source, tokens), one row each."""
    kind = dict(docs.dtypes)["doc_id"]
    docs = docs.where((F.col("tokens") > 0) & F.col("source").isin(*wanted)) if wanted else docs.limit(0)
    # Sizes by class of size: at most 64 rows for each listed source.
    classes = docs.groupBy("source", F.floor(F.log2("tokens")).alias("k")).agg(F.count("*").alias("n"), F.sum("tokens").alias("t")).collect()
    have: dict[str, int] = {}
    by_source: dict[str, list] = {}
    for r in classes:
        have[r["source"]] = have.get(r["source"], 0) + r["t"]
        by_source.setdefault(r["source"], []).append((r["t"] / r["n"], r["n"], r["t"]))
    planned = plan(wanted, have, total)
    spark = docs.sparkSession
    rows = [(s, p["copies"], float(p["rest"]), _factor(by_source[s], p["rest"]) if p["rest"] > 0 else 0.0) for s, p in planned.items()]
    known = spark.createDataFrame(rows, "source string, whole int, rest double, factor double") if rows else spark.createDataFrame([], "source string, whole int, rest double, factor double")
    u = (F.abs(F.xxhash64(F.lit(SEED), "doc_id") % 2**52) + 0.5) / F.lit(float(2**52))
    p = F.least(F.lit(1.0 - 1e-9), F.col("factor") * F.pow(F.col("tokens").cast("double"), F.lit(GAMMA)))
    odds = (u / (1 - u)) / (p / (1 - p))
    ranked = docs.join(F.broadcast(known), "source").withColumn("rank", F.when((F.col("rest") > 0) & (p > 0), odds / (1 + odds)))  # at most MAX_SOURCES rows
    ranked = ranked.withColumn("bucket", F.floor(F.col("rank") * BUCKETS))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    histogram = ranked.where("bucket is not null").groupBy("source", "bucket").agg(F.sum("tokens").alias("t")).withColumn("ahead", F.coalesce(F.sum("t").over(before), F.lit(0)))
    # At most BUCKETS rows a source, of MAX_SOURCES at most; documents without a rank have no bucket and meet nothing.
    placed = ranked.join(F.broadcast(histogram.select("source", "bucket", "ahead", "t")), ["source", "bucket"], "left")
    inside = (F.col("ahead") + F.col("t")) <= F.col("rest")
    edge = placed.where(F.col("bucket").isNotNull() & ~inside & (F.col("ahead") < F.col("rest")))
    order = Window.partitionBy("source", "bucket").orderBy("rank", "doc_id")
    # The last document is taken if that comes nearer to the tokens owed.
    upto = F.col("ahead") + F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("tokens") / 2
    taken = edge.withColumn("extra", (upto <= F.col("rest")).cast("int"))
    others = placed.where(F.col("bucket").isNull() | inside | (F.col("ahead") >= F.col("rest"))).withColumn("extra", F.coalesce(inside, F.lit(False)).cast("int"))
    used = taken.unionByName(others).select(F.col("doc_id").cast(kind).alias("doc_id"), "source", "tokens", (F.col("whole") + F.col("extra")).alias("copies"))
    return used.where("copies > 0"), planned


def _read(spark: SparkSession, sf: str) -> tuple[DataFrame, dict[str, tuple[float, int]]]:
    rows = fixed_size(table(spark, sf, "source_weight").select("source", "target_share", "max_repeats"), MAX_SOURCES, "source_weight")
    wanted = {r["source"]: (r["target_share"], r["max_repeats"]) for r in rows if r["source"] is not None and r["target_share"] and r["max_repeats"]}
    docs = table(spark, sf, "documents").select("doc_id", "source", "text").where(F.col("text").isNotNull() & F.col("source").isin(*wanted))
    counted = with_tokens(spread(docs), "text")
    return cut(counted.groupBy("doc_id").agg(F.max(F.struct("tokens", "source")).alias("r")).select("doc_id", "r.source", "r.tokens")), wanted


def mixture(spark: SparkSession, sf: str) -> DataFrame:
    """Every document used, with its tokens and how many times it is used."""
    docs, wanted = _read(spark, sf)
    return mix(docs, wanted)[0]


def shares(spark: SparkSession, sf: str) -> DataFrame:
    """For each listed source its target share, its share among sources with documents, and the share reached."""
    docs, wanted = _read(spark, sf)
    used, planned = mix(docs, wanted)
    reached = used.groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("used_tokens"), F.count("*").alias("documents"), F.max("copies").alias("most_copies"))
    listed = spark.createDataFrame([(s, float(w[0]), int(w[1]), planned.get(s, {}).get("share")) for s, w in sorted(wanted.items())], "source string, target_share double, max_repeats int, share_of_present double")
    total = reached.agg(F.sum("used_tokens").alias("total"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return listed.join(reached, "source", "left").join(F.broadcast(total)).select(  # one row
        "source", "target_share", "share_of_present", "max_repeats", zero("used_tokens"), zero("documents"), zero("most_copies"),
        F.round(F.coalesce(F.col("used_tokens") / F.col("total"), F.lit(0.0)), 6).alias("actual_share"),
    )


QUERIES = {"p8_mixture": mixture, "p8_shares": shares}
ORACLES: dict[str, str] = {}
