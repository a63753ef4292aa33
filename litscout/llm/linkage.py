"""Problem 3: new batches checked for repeats against all that was accepted before.

Method: incremental record linkage. A store in the shared folder keeps, batch by batch, the comparable rows, the distinct
titles of a batch with their blocking keys (telling words with their one-edit variants, and keys of whole titles), and the
log of a union-find (id, an earlier row of its article). A batch probes the stored keys, scores candidate pairs with weights
learned from pairs whose identifiers tell the answer, and appends the links of its rows; nothing accepted is compared again
with anything accepted, and the log is followed to the representatives when they are asked for. Each shuffle or broadcast keeps
a thread of the driver, with memory of its own, for a minute: a batch takes as few as it can. What is stored is not shuffled for a batch: its keys are filtered where they are read by those of
the batch, and titles are fetched for the pairs found. Only for a batch of more than FEW keys or pairs both sides are shuffled.

Rows that share an identifier are linked to the smallest id of that identifier, not pairwise. Titles are compared only
where neither pmid nor doi decides; only the best earlier row is linked. Each distinct title of a batch (of one year, with or
without pmid and doi) is compared once, for all rows that have it. Words that a large share of the first batch's titles has
block nothing, even if they are the name of one article that holds them all: titles without a telling word meet by their
rarest words, and those that differ in one word by the others. The words that a shortened title may lack, and the weights,
are learned again whenever the store has doubled. The smallest candidate_id represents a cluster.

Defined results: null and empty identifiers and titles block nothing; a title of fewer than four words (such as "reply by
the authors") is never matched by title alone. Rows repeated under one id count once. Null ids are left out; a null batch
comes first. Very long titles are compared whole.
"""

from __future__ import annotations

import math
import uuid
from collections import defaultdict

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from litscout.llm import titles
from litscout.llm.formatting import plain_doi
from litscout.session import cut, fixed_size, shared_dir, table

SAMPLE = 3_000  #: rows from which weights are learned, at most
PAIRS = 60_000  #: pairs of them, at most
MAX_BATCHES = 10_000
FEW = 500_000  #: keys or pairs that are broadcast; more are joined by shuffle
LEVELS, YEARS = (0, 1, 2, 3), ("same", "next", "far", "none")
#: What is expected before any data, with the weight of PRIOR pairs: shares of levels among equal and other articles.
EXPECTED = {"m": (0.02, 0.04, 0.06, 0.88), "u": (0.985, 0.005, 0.005, 0.005), "my": (0.85, 0.05, 0.04, 0.06), "uy": (0.06, 0.1, 0.78, 0.06)}
PRIOR = 50


def plain_pmid(c: Column) -> Column:
    """The number of a pmid without prefix, leading zeros and decimals; null without one."""
    return F.nullif(F.regexp_replace(F.regexp_extract(c, r"(\d+)", 1), "^0+", ""), F.lit(""))


def year_level(a: Column | int | None, b: Column | int | None) -> str:
    return "none" if a is None or b is None else "same" if a == b else "next" if abs(a - b) == 1 else "far"


class Weights:
    """Log2 ratios of how often a level of agreement occurs among pairs of one article and of others."""

    def __init__(self, pairs: list[tuple[bool, int, str]] = ()) -> None:
        count = lambda names, at, same, expected: [
            PRIOR * e + sum(1 for p in pairs if p[0] is same and p[at] == n) for n, e in zip(names, expected)
        ]
        ratio = lambda m, u: [math.log2((a / sum(m)) / (b / sum(u))) for a, b in zip(m, u)]
        self.title = dict(zip(LEVELS, ratio(count(LEVELS, 1, True, EXPECTED["m"]), count(LEVELS, 1, False, EXPECTED["u"]))))
        self.year = dict(zip(YEARS, ratio(count(YEARS, 2, True, EXPECTED["my"]), count(YEARS, 2, False, EXPECTED["uy"]))))
        same = sum(1 for p in pairs if p[0])
        self.prior = math.log2((same + PRIOR * 0.1) / (len(pairs) - same + PRIOR * 0.9))

    def score(self, level: int, year: str) -> float:
        return self.prior + self.title[level] + self.year[year]


def comparable(df: DataFrame, phrases: dict[str, str]) -> DataFrame:
    """(id, batch, pmid, doi, tokens, part, year) of pubmed_candidate rows, one for each id."""
    rows = titles.with_tokens(df, F.coalesce(F.nullif(F.trim("title"), F.lit("")), F.col("normalized_title")), phrases)
    rows = rows.select(
        F.col("candidate_id").alias("id"), F.coalesce("batch_no", F.lit(-1)).alias("batch"), plain_pmid(F.col("pmid")).alias("pmid"), plain_doi(F.col("doi")).alias("doi"), "tokens", "part",
        F.col("publication_year").alias("year"),
    )
    return rows.where("id is not null").dropDuplicates(["id"])


def learn(rows: DataFrame, common: list[str]) -> Weights:
    """Weights from pairs that share a telling token and both have a pmid: a bounded sample of rows, by a hash of the token,
    so that those that share one come together."""
    first = rows.where("pmid is not null").withColumn("w", F.try_element_at(titles.telling(F.col("tokens"), common), F.lit(1)))
    sample = first.where("w is not null").orderBy(F.xxhash64("w"), "id").limit(SAMPLE).select("w", "pmid", "tokens", "part", "year").collect()
    blocks, pairs, known = defaultdict(list), [], set(common)
    for r in sample:
        blocks[r["w"]].append(r)
    for block in blocks.values():
        for k, a in enumerate(block):
            for b in block[:k]:
                if len(pairs) < PAIRS:
                    close = titles.level(a["tokens"], b["tokens"], known) if a["part"] == b["part"] else 0
                    pairs.append((a["pmid"] == b["pmid"], close, year_level(a["year"], b["year"])))
    return Weights(pairs)


def score_pairs(pairs: DataFrame, common: list[str], weights: Weights) -> DataFrame:
    """Adds score to pairs with tokens_a, part_a, year_a and the same of b."""
    known = set(common)

    @F.pandas_udf("double")
    def score(ta: pd.Series, tb: pd.Series, pa: pd.Series, pb: pd.Series, ya: pd.Series, yb: pd.Series) -> pd.Series:
        year = lambda v: None if pd.isna(v) else int(v)
        out = []
        for a, b, p, q, y, z in zip(ta, tb, pa, pb, ya, yb):
            close = titles.level(list(a), list(b), known) if p == q else 0
            out.append(weights.score(close, year_level(year(y), year(z))) if close else -99.0)
        return pd.Series(out, dtype="float64")

    return pairs.withColumn("score", score("tokens_a", "tokens_b", "part_a", "part_b", "year_a", "year_b"))


class Store:
    """What is kept between batches, as Parquet in the shared folder: rows, titles with keys and the union-find log, by batch."""

    def __init__(self, spark: SparkSession, phrases: dict[str, str], folder: str | None = None) -> None:
        self.spark, self.phrases = spark, phrases
        self.folder = folder or f"{shared_dir(spark)}/linkage-{uuid.uuid4().hex}"
        self.batches: list[int] = []
        self.common: list[str] = []  #: words that block nothing: those of the first batch, so that all stored keys agree
        self.droppable: list[str] = []  #: words that a title may lack
        self.weights = Weights()
        self.rows = self.learned = self.new_ids = self.new_keys = 0
        self.schemas: dict[str, T.StructType] = {}  #: of what is stored, so that no job is spent to find them

    def _read(self, name: str, batches: list[int]) -> DataFrame:
        reader = self.spark.read.schema(self.schemas[name]) if name in self.schemas else self.spark.read
        return reader.parquet(*[f"{self.folder}/{name}/{b}" for b in batches])

    def _write(self, df: DataFrame, name: str, number: int, size: Column | None = None) -> int:
        """Store a frame, and sum up a size of its rows (1 each, if none is given) while it is written."""
        seen, self.schemas[name] = Observation(), df.schema
        df.observe(seen, F.coalesce(F.sum(F.lit(1) if size is None else size), F.lit(0)).alias("n")).write.parquet(f"{self.folder}/{name}/{number}")
        return seen.get["n"]

    def prepare(self, df: DataFrame, number: int) -> None:
        """Store the comparable rows of a batch, and its distinct titles with their keys. The first batch gives the vocabulary."""
        same = F.struct("tokens", "part", "year", F.col("pmid").isNotNull().alias("p"), F.col("doi").isNotNull().alias("d"))
        count = self._write(comparable(df, self.phrases).withColumn("same", F.md5(F.to_json(same))), "rows", number)
        rows = self._read("rows", [number])
        self.rows, self.new_ids = self.rows + count, 2 * count
        first = not self.batches
        self.batches.append(number)
        if first or self.rows >= 2 * self.learned:
            every = self._read("rows", self.batches)
            self.droppable = titles.common_tokens(every)
            self.common = self.droppable if first else self.common
            self.weights = learn(every, self.droppable)
            self.learned = self.rows
        distinct = rows.where(F.size("tokens") >= titles.LEAST_TOKENS).groupBy("same", "tokens", "part", "year", F.col("pmid").isNotNull().alias("p"), F.col("doi").isNotNull().alias("d")).agg(F.min("id").alias("id"), F.max("id").alias("last"))
        tokens = F.col("tokens")
        keys = F.array_distinct(F.concat(titles.variants(titles.telling(tokens, self.common)), titles.title_keys(tokens, F.col("part"), self.common)))
        self.new_keys = self._write(distinct.withColumn("sig", titles.signature(tokens)).withColumn("keys", keys), "titles", number, F.size("keys"))

    def _met(self, ours: DataFrame, size: int, stored: DataFrame, key: str, how: str = "inner") -> DataFrame:
        """ours, of a known size, joined with the stored rows of the same key; the stored side stays where it is if ours is small
        enough to be sent there."""
        return stored.join(F.broadcast(ours) if size <= FEW else ours, key, how)

    def probe(self, number: int) -> DataFrame:
        """(id, earlier): links of the rows of a batch to earlier rows, at least one for each row that repeats an article; a link may
        come twice."""
        hashes = F.explode(F.array_compact(F.array(F.when(F.col("pmid").isNotNull(), F.xxhash64(F.lit("p"), "pmid")), F.when(F.col("doi").isNotNull(), F.xxhash64(F.lit("d"), "doi")))))
        own = self._read("rows", [number]).select("id", hashes.alias("key"))
        stored = self._read("rows", self.batches).select(F.col("id").alias("earlier"), hashes.alias("key"))
        first = self._met(own.select("key"), self.new_ids, stored, "key", "left_semi").groupBy("key").agg(F.min("earlier").alias("earlier"))
        links = self._met(first, self.new_ids, own, "key").where("earlier < id").select("id", "earlier")
        best = self.probe_titles(number).groupBy("ia").agg(F.max_by("ib", F.struct("score", -F.col("ib"))).alias("earlier"))
        return links.unionByName(best.select(F.col("ia").alias("id"), "earlier"))

    def probe_titles(self, number: int) -> DataFrame:
        """(ia, ib, score): rows of a batch and the earlier rows that they match by keys of distinct titles. Each pair of distinct
        titles is scored once. A row needs its best earlier row only, so that of what a title matches, by id, only what is
        better than all before it goes to the title's rows."""
        new, every = self._read("titles", [number]), self._read("titles", self.batches)
        side = lambda df, s: df.select(F.explode("keys").alias("key"), F.col("id").alias(f"i{s}"), *[F.col(c).alias(f"{c}{s}") for c in ("p", "d", "sig", "last")])
        met = self._met(side(new, "a"), self.new_keys, side(every, "b"), "key").where("ib < lasta and not (pa and pb) and not (da and db)").where(titles.may_match(F.col("siga"), F.col("sigb"))).select("ia", "ib")
        fields = lambda df, s, *more: df.select(F.col("id").alias(f"i{s}"), *more, *[F.col(c).alias(f"{c}_{s}") for c in ("tokens", "part", "year")])
        count = self._write(met.distinct(), "pairs", number)
        pairs = self._read("pairs", [number]).join(fields(new, "a", "same"), "ia")
        scored = score_pairs(self._met(pairs, count, fields(every, "b"), "ib"), self.droppable, self.weights).where("score > 0").select("same", "ib", "score")
        before = Window.partitionBy("same").orderBy("ib").rowsBetween(Window.unboundedPreceding, -1)
        better = scored.withColumn("most", F.max("score").over(before)).where("most is null or score > most").drop("most")
        rows = self._read("rows", [number]).select(F.col("id").alias("ia"), "same")
        return rows.join(better, "same").where("ib < ia").select("ia", "ib", "score")

    def accept(self, df: DataFrame, number: int) -> None:
        """Check a batch and accept it: the links of its rows are appended to the log."""
        self.prepare(df, number)
        log = self.probe(number).withColumnRenamed("earlier", "parent")
        self.schemas["log"] = log.schema
        log.write.parquet(f"{self.folder}/log/{number}")
        # Spark removes the shuffles and broadcasts of finished jobs when the driver lets go of them, which a batch after batch of
        # small jobs would put off until its heap is full.
        self.spark._jvm.System.gc()

    def representatives(self) -> DataFrame:
        """(id, root) of all rows that are not the first of their article."""
        return closure(self._read("log", self.batches))


def closure(parents: DataFrame) -> DataFrame:
    """(id, root): unions (id, parent), parent < id, followed to the smallest id of each set. Every turn takes the smallest
    parent, hangs the others under it and skips a generation, so that the turns grow with the logarithm of the depth."""
    # Two sets of unions are taken to be the same if they are as many and their hashes have the same sum.
    mark = lambda df: tuple(df.agg(F.count("*"), F.sum(F.xxhash64("id", "parent").cast("decimal(20,0)"))).first())
    now = cut(parents.distinct())
    held = mark(now)
    while True:
        least = now.groupBy("id").agg(F.min("parent").alias("parent"), F.count("*").alias("n"))
        others = now.join(least.where("n > 1").select("id", F.col("parent").alias("low")), "id").where("parent <> low").select(F.col("parent").alias("id"), F.col("low").alias("parent"))
        above = least.select(F.col("id").alias("parent"), F.col("parent").alias("up"))
        jumped = least.join(above, "parent", "left").select("id", F.coalesce("up", "parent").alias("parent"))
        now = cut(jumped.unionByName(others).distinct())
        before, held = held, mark(now)
        if held == before:
            return now.withColumnRenamed("parent", "root")


def found(spark: SparkSession, sf: str) -> DataFrame:
    """All batches of pubmed_candidate in order, each accepted into one store."""
    df = table(spark, sf, "pubmed_candidate").select("candidate_id", F.coalesce("batch_no", F.lit(-1)).alias("batch_no"), "pmid", "doi", "title", "normalized_title", "publication_year")
    store = Store(spark, titles.vocabulary(spark, sf))
    numbers = sorted(r["batch_no"] for r in fixed_size(df.select("batch_no").distinct(), MAX_BATCHES, "the list of batches"))
    for number in numbers:
        store.accept(df.where(F.col("batch_no") == number), number)
    if not numbers:
        return spark.createDataFrame([], "candidate_id_a bigint, candidate_id_b bigint")
    return store.representatives().select(F.col("root").alias("candidate_id_a"), F.col("id").alias("candidate_id_b"))


QUERIES = {"p3_found": found}
ORACLES: dict[str, str] = {}
