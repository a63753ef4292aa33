"""Titles of studies as comparable tokens, shared by incremental linkage and key-less matching."""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from litscout.llm.canonical import distance
from litscout.session import fixed_size, table

MAX_PHRASES = 20_000
COMMON_SHARE, COMMON_LEAST = 0.01, 4
SHORTEST = 4  #: letters of a telling token
LEAST_TOKENS = 4  #: of a title that can be matched by its words alone
SHARED = 3  #: words that matching titles share at least, besides half of those of the shorter

# Phrases of Portuguese titles that ontology_entity has not, with their English, and English wordings of one meaning.
PHRASES = {
    "apetite": "appetite", "estabilidade do humor": "mood stability", "qualidade do sono": "sleep quality", "marcadores inflamatorios": "inflammatory markers",
    "funcionamento diario": "daily functioning", "seguranca hepatica": "liver safety", "memoria de trabalho": "working memory", "adesao ao tratamento": "treatment adherence",
    "intensidade da dor": "pain intensity", "frequencia de crises": "seizure frequency", "uso de medicacao de resgate": "rescue medication use", "pressao arterial": "blood pressure",
    "pessoas idosas": "older adults", "veteranos militares": "military veterans", "adolescentes": "adolescents", "pacientes em cuidados paliativos": "palliative care patients",
    "pacientes ambulatoriais adultos": "adult outpatients", "pacientes internados": "hospital inpatients", "criancas": "children", "trabalhadores em turnos": "shift workers",
    "moradores de areas rurais": "rural residents", "voluntarias gravidas": "pregnant volunteers", "por via sublingual": "sublingual", "em baixa dose": "lowdose", "em alta dose": "highdose",
    "de uso prolongado": "longterm", "de uso topico": "topical", "como terapia adjuvante": "addon", "por inalacao": "inhaled", "segunda coorte": "second cohort", "fase de seguimento": "followup phase",
    "low dose": "lowdose", "high dose": "highdose", "long term": "longterm", "prolonged": "longterm", "add on": "addon", "adjunctive": "addon", "open label": "openlabel", "meta analysis": "metaanalysis",
    "case control": "casecontrol", "whole plant": "wholeplant", "post traumatic": "posttraumatic", "chemotherapy induced": "chemotherapyinduced", "follow up": "followup", "investigation": "study",
    "case report": "casereport", "clinical trial": "trial", "elderly": "older", "pediatric patients": "children", "paediatric patients": "children", "randomized": "randomised", "dis": "disease",
    "in the treatment of": "", "the effects of": "", "effects of": "", "results from": "", "results of": "", "report on": "",
}
PARTS = {"second cohort": "cohort2", "third cohort": "cohort3", "followup phase": "followup", "followup study": "followup"}
STOP = set("of for in from at the on a an to and with by o os as um uma de da do das dos em no na nos nas para sobre por com ao".split())
NOISE = set("retracted retraction retracao corrected correction corrigido erratum notice errata results effects report clinical hospital adult treatment".split())


def simple(text: str) -> str:
    """Lower-case ASCII words; words joined by hyphens are one."""
    folded = unicodedata.normalize("NFKD", text.replace("_", " "))
    folded = "".join(ch for ch in folded if not unicodedata.combining(ch)).lower()
    return " ".join(re.findall(r"[a-z0-9]+", re.sub(r"(?<=\w)[-‐‑–](?=\w)", "", folded)))


def vocabulary(spark: SparkSession, sf: str) -> dict[str, str]:
    """Phrases and what they become: the fixed ones, and labels and aliases of ontology_entity to the English label."""
    rows = fixed_size(table(spark, sf, "ontology_entity").select("canonical_label", "canonical_label_en", "aliases_json"), MAX_PHRASES, "ontology_entity")
    known = {}
    for r in rows:
        if r["canonical_label_en"]:
            names = [r["canonical_label"] or "", *re.findall(r'"([^"]+)"', r["aliases_json"] or "")]
            known |= {simple(n): simple(r["canonical_label_en"]) for n in names if len(simple(n)) > 2}
    return known | PHRASES


class Reader:
    """Titles to (tokens, part): phrases replaced by one wording, stop and notice words dropped."""

    def __init__(self, phrases: dict[str, str]) -> None:
        self.phrases = {k: v for k, v in phrases.items() if k and k != v}
        # Single long words of the phrases, by what they become without a letter or two: slips of the pen in them.
        self.single = {k for k in self.phrases if " " not in k and len(k) > 8}
        self.stubs: dict[str, set[str]] = {}
        for word in self.single:
            for stub in Bare._without_two(word):
                self.stubs.setdefault(stub, set()).add(word)
        self.words = {w for v in (*self.phrases, *self.phrases.values()) for w in v.split()}
        self.pattern = re.compile(r"\b(?:" + "|".join(map(re.escape, sorted(self.phrases, key=lambda k: (-len(k), k)))) + r")\b")

    def meant(self, word: str) -> str:
        """The word of the phrases of which a word is a slip of the pen; the word itself if it is none, or of several."""
        if len(word) < 8 or word in self.words:
            return word
        near = {w for stub in Bare._without_two(word) for w in self.stubs.get(stub, ()) if distance(word, w, 2) <= 2}
        return near.pop() if len(near) == 1 else word

    def read(self, title: str | None) -> tuple[list[str], str]:
        text = " ".join(map(self.meant, simple(title or "").split()))
        for _ in range(2):  # a replacement may complete another phrase
            text = " ".join(self.pattern.sub(lambda m: self.phrases[m.group()], text).split())
        part = ""
        for phrase, name in PARTS.items():
            if re.search(rf"\b{phrase}\b", text):
                part, text = name, re.sub(rf"\b{phrase}\b", " ", text)
        return [w for w in text.split() if w not in STOP and w not in NOISE], part


def with_tokens(df: DataFrame, title: Column, phrases: dict[str, str]) -> DataFrame:
    """Adds tokens and part of a title; no tokens for null."""
    reader = Reader(phrases)

    @F.pandas_udf("struct<tokens:array<string>,part:string>")
    def read(values: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([reader.read(v if isinstance(v, str) else None) for v in values], columns=["tokens", "part"])

    return df.withColumn("_read", read(title)).withColumn("tokens", F.col("_read.tokens")).withColumn("part", F.col("_read.part")).drop("_read")


def common_tokens(df: DataFrame) -> list[str]:
    """Tokens in at least COMMON_SHARE of the titles (and COMMON_LEAST of them). There are at most as many as a title has
    tokens on average, over COMMON_SHARE. The rarest comes first."""
    counts = df.select(F.explode(F.array_distinct("tokens")).alias("w")).groupBy("w").count()
    total = df.where(F.size("tokens") > 0).count()
    least = max(COMMON_LEAST, COMMON_SHARE * total)
    return [w for _, w in sorted((r["count"], r["w"]) for r in counts.where(F.col("count") >= least).toLocalIterator())]


def telling(tokens: Column, common: list[str]) -> Column:
    """The tokens that are not common, each once."""
    rare = F.array_except(tokens, F.split(F.lit(" ".join(common)), " ")) if common else F.array_distinct(tokens)  # one literal
    return F.filter(rare, lambda w: F.length(w) >= SHORTEST)


def variants(tokens: Column) -> Column:
    """Hashes of the tokens and of all they become without one character: tokens within one edit share one."""
    drop = lambda w: F.transform(F.sequence(F.lit(1), F.length(w)), lambda i: F.xxhash64(F.concat(F.substring(w, F.lit(1), i - 1), F.substring(w, i + 1, F.length(w)))))
    return F.array_distinct(F.flatten(F.transform(tokens, lambda w: F.concat(F.array(F.xxhash64(w)), drop(w)))))


def signature(tokens: Column) -> Column:
    """The words of a title as numbers, to be carried beside its blocking keys."""
    return F.array_distinct(F.transform(tokens, lambda w: F.hash(w)))


def may_match(a: Column, b: Column) -> Column:
    """What level() asks for before all else, of signatures: a join condition that drops no pair with a level above 0 (equal
    numbers of different words can only let more pass)."""
    shared = F.size(F.array_intersect(a, b))
    return (shared >= SHARED) & (2 * shared >= F.least(F.size(a), F.size(b)))


def whole_keys(tokens: Column, part: Column, common: list[str]) -> Column:
    """Hashes of a title's words as a set, and of the set without each telling word (without each word, if none is telling).
    Such keys may be shared by any number of rows: they are for distinct titles."""
    words = F.array_sort(F.array_distinct(tokens))
    rare = telling(tokens, common)
    out = F.when(F.size(rare) > 0, rare).otherwise(words)
    name = lambda ws: F.xxhash64(F.array_join(ws, " "), part)
    keys = F.array_distinct(F.concat(F.array(name(words)), F.transform(out, lambda w: name(F.array_remove(words, w)))))
    return F.when(F.size(words) >= LEAST_TOKENS, keys).otherwise(F.array().cast("array<bigint>"))


class Bare:
    """Finds titles none of whose words is sure to tell its article, because the article holds a large share of all rows:
    without a telling word, or with such only that may be slips of common or dropped words, or such words run together (they
    begin or end like one). Of titles that share no telling word, only such can have a level above 0, but for telling words
    that differ by more than their variants allow."""

    def __init__(self, common: list[str]) -> None:
        self.common, self.rank = common, {w: k for k, w in enumerate(common)}
        self.ends = {e for w in common if len(w) >= SHORTEST for e in (("a", w[:SHORTEST]), ("z", w[-SHORTEST:]))}
        self.stubs: dict[str, list[str]] = {}
        for w in common:
            for stub in self._without_two(w):
                self.stubs.setdefault(stub, []).append(w)
        self.known: dict[str, bool] = {}

    @staticmethod
    def _without_two(w: str) -> set[str]:
        one = {w[:k] + w[k + 1 :] for k in range(len(w))}
        return {w} | one | {v[:k] + v[k + 1 :] for v in one for k in range(len(v))}

    def slip(self, word: str) -> bool:
        if word not in self.known:
            if len(self.known) > 200_000:
                self.known.clear()
            near = len(word) == SHORTEST or _noise(word) or ("a", word[:SHORTEST]) in self.ends or ("z", word[-SHORTEST:]) in self.ends
            near = near or any(distance(word, w, 2) <= (1 if max(len(word), len(w)) < 6 else 2) for w in {w for stub in self._without_two(word) for w in self.stubs.get(stub, ())})
            self.known[word] = near
        return self.known[word]

    def prefix(self, tokens: list[str]) -> list[str]:
        """Words of which two bare titles share one if they share SHARED words: all but the SHARED - 1 most common."""
        if len(tokens) < LEAST_TOKENS:
            return []
        words = set(tokens)
        telling = {w for w in words if len(w) >= SHORTEST and w not in self.rank}
        if not all(map(self.slip, telling)):
            return []
        return sorted(words - telling, key=lambda w: (self.rank.get(w, -1), w))[: 1 - SHARED]


def title_keys(tokens: Column, part: Column, common: list[str]) -> Column:
    """Keys by which distinct titles meet without a telling word: whole_keys() and the rarest words of bare titles."""
    bare = Bare(common)

    @F.pandas_udf("array<string>")
    def prefix(values: pd.Series) -> pd.Series:
        return pd.Series([bare.prefix([] if v is None else list(v)) for v in values], dtype=object)

    return F.array_distinct(F.concat(whole_keys(tokens, part, common), F.transform(prefix(tokens), lambda w: F.xxhash64(F.lit("bare"), w, part))))


def _left(a: list[str], b: list[str]) -> list[int]:
    """Positions in a of what b has not."""
    have, out = Counter(b), []
    for k, w in enumerate(a):
        if have[w]:
            have[w] -= 1
        else:
            out.append(k)
    return out


_NEAR_NOISE = {v for n in NOISE if len(n) > 4 for v in [n, *(n[:k] + n[k + 1 :] for k in range(len(n)))]}


def _noise(word: str) -> bool:
    """A slip of the pen in a word that would have been dropped: both share a form without one letter."""
    return len(word) > 4 and (word in _NEAR_NOISE or any(word[:k] + word[k + 1 :] in _NEAR_NOISE for k in range(len(word))))


def _slips(a: list[str], i: list[int], b: list[str], j: list[int]) -> bool:
    """Whether the words at some places, run together, differ by slips of the pen only."""
    x, y = "".join(a[k] for k in i), "".join(b[k] for k in j)
    allowed = 1 if max(len(x), len(y)) < 7 else 2 if max(len(x), len(y)) < 14 else 3
    return distance(x, y, allowed) <= allowed


class Screen:
    """Finds the pairs of the titles of a block that level() may give more than 0, for whole blocks at once. Every condition is one
    that level() asks for: may_match(); and of the words that are left, those of one title are slips of the other's and three
    remain there at most, or all of them run together differ by three edits. Slips are known of common words; any other word may be
    a slip of each. Edits of letters are bounded by how often the titles have each letter."""

    CELLS = 1_000_000  #: pairs looked at together
    LETTERS = "abcdefghijklmnopqrstuvwxyz"  #: digits count together, behind them

    def __init__(self, common: list[str]) -> None:
        self.at = {w: k for k, w in enumerate(common)}
        self.counts = np.array([not _noise(w) for w in common], dtype="float32")  # words near to notice words go before slips are sought
        near = np.eye(len(common), dtype="float32")
        for k, x in enumerate(common):
            for m, y in enumerate(common[:k]):
                most = 1 if max(len(x), len(y)) < 6 else 2
                near[k, m] = near[m, k] = distance(x, y, most) <= most
        self.near = near

    def words(self, tokens: list[str]) -> list[int]:
        """Places of common words, and numbers of the others behind them (equal numbers of different words let more pass)."""
        return sorted({self.at[w] if w in self.at else len(self.at) + zlib.crc32(w.encode()) for w in tokens})

    def letters(self, tokens: list[str]) -> bytes:
        """How often each letter occurs, in all words and in those that level() keeps."""
        count = lambda text: [*(text.count(c) for c in self.LETTERS), sum(map(str.isdigit, text))]
        return bytes(min(255, n) for n in (*count("".join(tokens)), *count("".join(w for w in tokens if not _noise(w)))))

    def pairs(self, a: list, b: list, la: np.ndarray, lb: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of the pairs left, of words() and letters() of the titles of each side."""
        step = max(1, self.CELLS // len(b))
        for k in range(0, len(a), step):
            i, j = self._some(a[k : k + step], b, la[k : k + step], lb)
            yield i + k, j

    def _some(self, a: list, b: list, la: np.ndarray, lb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lengths = [len(w) for w in (*a, *b)]
        words, where = np.unique(np.concatenate([*a, *b]).astype("int64"), return_inverse=True)
        has = np.zeros((len(lengths), len(words)), dtype="float32")
        has[np.repeat(np.arange(len(lengths)), lengths), where] = 1
        x, y = has[: len(a)], has[len(a) :]
        shared = x @ y.T
        ok = (shared >= SHARED) & (2 * shared >= np.minimum.outer(x.sum(1), y.sum(1)))
        if not ok.any():
            return np.empty(0, dtype=int), np.empty(0, dtype=int)
        known = words < len(self.at)
        places = words[known]
        near = self.near[np.ix_(places, places)]
        free_x, free_y = x[:, ~known].sum(1)[:, None], y[:, ~known].sum(1)[None, :]
        x, y = x[:, known], y[:, known]
        own_x, own_y = x * self.counts[places], y * self.counts[places]
        left_y = own_y.sum(1)[None, :] - (x @ near > 0).astype("float32") @ own_y.T
        left_x = own_x.sum(1)[:, None] - own_x @ (y @ near > 0).astype("float32").T
        slips = ((left_y <= free_x) & (left_x <= 3 + free_y)) | ((left_x <= free_y) & (left_y <= 3 + free_x))
        i, j = np.nonzero(ok & ~slips)
        apart = np.abs(la[i].astype("int16") - lb[j].astype("int16")).reshape(len(i), 2, la.shape[1] // 2).sum(2).min(1) <= 6  # an edit changes two letters
        more_i, more_j = np.nonzero(ok & slips)
        return np.concatenate([i[apart], more_i]), np.concatenate([j[apart], more_j])


def meet(ours: DataFrame, theirs: DataFrame, common: list[str]) -> DataFrame:
    """(a, b, word): pairs of distinct titles (title, tokens, part) that share a key and that level() may give more than 0, and
    whether a telling word is such a key. Blocks are read one after the other, sorted by key, and screened whole."""
    screen = Screen(common)

    @F.pandas_udf("struct<words:array<bigint>,letters:binary>")
    def read(tokens: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([(screen.words(list(t)), screen.letters(list(t))) for t in tokens], columns=["words", "letters"])

    def side(df: DataFrame, mine: bool) -> DataFrame:
        named = lambda keys, word: F.transform(keys, lambda k: F.struct(F.lit(word).alias("word"), k.alias("key")))
        keys = F.concat(named(variants(telling(F.col("tokens"), common)), True), named(title_keys(F.col("tokens"), F.col("part"), common), False))
        held = df.where(F.size("tokens") >= LEAST_TOKENS).select("title", "part", read("tokens").alias("r"), keys.alias("keys"))
        return held.select(F.lit(mine).alias("mine"), "title", "part", "r.words", "r.letters", F.explode("keys").alias("k")).select("mine", "title", "part", "words", "letters", "k.word", "k.key")

    def blocks(df: pd.DataFrame) -> Iterator[pd.DataFrame]:
        mine, starts = df["mine"].to_numpy(), np.append(np.flatnonzero(_new_block(df)), len(df))
        words, letters, title, word = df["words"].to_numpy(), df["letters"].to_numpy(), df["title"].to_numpy(), df["word"].to_numpy()
        count = np.add.reduceat(mine.astype(int), starts[:-1]) if len(df) else np.empty(0)
        for k in np.flatnonzero((count > 0) & (count < np.diff(starts))):
            mid, at = starts[k] + count[k], slice(starts[k], starts[k + 1])  # ours are first
            table = np.frombuffer(b"".join(letters[at]), dtype="uint8").reshape(at.stop - at.start, -1)
            for i, j in screen.pairs(list(words[at.start : mid]), list(words[mid : at.stop]), table[: count[k]], table[count[k] :]):
                if len(i):
                    yield pd.DataFrame({"a": title[at.start : mid][i], "b": title[mid : at.stop][j], "word": word[at.start]})

    def found(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None  # of the last block, which may go on
        for df in batches:
            df = df if rest is None else pd.concat([rest, df], ignore_index=True)
            last = int(np.flatnonzero(_new_block(df))[-1]) if len(df) else 0
            yield from blocks(df.iloc[:last])
            rest = df.iloc[last:].reset_index(drop=True)
        if rest is not None:
            yield from blocks(rest)

    rows = side(ours, True).unionByName(side(theirs, False)).repartition("word", "key", "part").sortWithinPartitions("word", "key", "part", F.desc("mine"))
    return rows.mapInPandas(found, "a string, b string, word boolean").groupBy("a", "b").agg(F.max("word").alias("word"))


def _new_block(df: pd.DataFrame) -> np.ndarray:
    """Where a row has another key than the row before."""
    out = np.ones(len(df), dtype=bool)
    if len(df) > 1:
        out[1:] = np.logical_or.reduce([df[c].to_numpy()[1:] != df[c].to_numpy()[:-1] for c in ("word", "key", "part")])
    return out


def level(a: list[str], b: list[str], common: set[str]) -> int:
    """3: the same words in any order. 2: but for slips of the pen. 1: one title lacks a phrase at its start or end, slips
    apart. 0: neither."""
    if min(len(a), len(b)) < LEAST_TOKENS:
        return 0
    i, j = _left(a, b), _left(b, a)
    if not i and not j:
        return 3
    x, y = set(a), set(b)
    if (shared := len(x & y)) < SHARED or 2 * shared < min(len(x), len(y)):
        return 0
    if i and j and _slips(a, i, b, j):  # before words near to notice words go, which may be halves of others: "case reprot"
        return 2
    i, j = [k for k in i if not _noise(a[k])], [k for k in j if not _noise(b[k])]
    if not i and not j:
        return 2
    if i and j:
        if _slips(a, i, b, j):
            return 2
        # Slips word by word; what remains must be a phrase of one title only.
        for k in list(i):
            best = next((m for m in j if distance(a[k], b[m], 2) <= (1 if len(a[k]) < 6 else 2)), None)
            if best is not None:
                i.remove(k)
                j.remove(best)
    if bool(i) != bool(j):
        words, at = (a, i) if i else (b, j)
        edge = at == list(range(len(at))) or at == list(range(len(words) - len(at), len(words)))
        if edge and len(at) <= 3 and all(words[k] in common for k in at):
            return 1
    return 2 if not i and not j else 0
