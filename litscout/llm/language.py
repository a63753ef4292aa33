"""Problem 1: the language of texts, of their parts, and of titles.

Method: a byte convolutional network in numpy. Bytes of a window of fixed length are embedded, filters of several widths
run over them, the greatest response of each filter goes to a softmax over the languages. It is trained on labelled
texts (documents.text with documents.lang), on a bounded sample: SAMPLE rows for each language, chosen by a hash of their
key, PER_ROW windows of each. Labels are not trusted wholly (texts hold foreign passages): after a first training,
windows of which the network is sure that they are in another language are left out of the second. Training texts are
used with and without accents, always in lower case, so that capitals and lost accents do not matter.

A text is cut into sentences and these into windows. The languages of a text's sentences are the most likely sequence
given the mean log probabilities of their windows and the chance SWITCH that the language changes between two sentences;
neighbouring sentences of one language form a part. Texts are read whole, in batches of windows.

Defined results: null, empty and letterless texts have no language: no part, no row; nor has any text where nothing is
labelled. Ties go to the first of LANGUAGES.
Repeated rows give the same rows once.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from litscout.session import spread, table

LANGUAGES = ("en", "pt", "es", "fr", "de")
SAMPLE = 400  #: labelled rows of each language for training; at most 1,000, so that Spark limits groups before the shuffle
PER_ROW = 8
LEAST = 800  #: training windows of a language, at least; of few texts they are drawn again and again
LENGTH = 96
WIDTHS = (2, 3, 4, 5, 6)
EMBED, FILTERS = 12, 24
EPOCHS, STEP, BATCH, DROP = 5, 0.01, 128, 0.3
FIRST = 0.3  #: share of training windows from the first line of a text, often its title
SURE = 0.9
SWITCH = 0.05

# How the languages are written as labels, in lower case and without accents.
LABELS = {
    "en": "en eng english ingles anglais englisch inglese",
    "pt": "pt por portuguese portugues portugais portugiesisch",
    "es": "es spa esp spanish espanol castellano espanhol castelhano espagnol spanisch",
    "fr": "fr fra fre french francais frances franzosisch",
    "de": "de deu ger german deutsch aleman alemao allemand",
}

_BREAK = re.compile(r"(?<=[.!?])\s+|\s*\n\s*")


def windows(text: str) -> list[bytes]:
    """Windows of LENGTH bytes that cover a text; the last ends where the text ends."""
    data = " ".join(text.lower().split()).encode("utf-8", "ignore")
    if len(data) <= LENGTH:
        return [data]
    starts = [*range(0, len(data) - LENGTH, LENGTH), len(data) - LENGTH]
    return [data[s : s + LENGTH] for s in starts]


def encode(parts: list[bytes]) -> np.ndarray:
    """A matrix of bytes, padded with zeros."""
    return np.frombuffer(b"".join(p.ljust(LENGTH, b"\0") for p in parts), dtype=np.uint8).reshape(len(parts), LENGTH)


class Network:
    """Embedding, filters of several widths, maximum over positions, softmax; trained by Adam."""

    def __init__(self, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        scale = lambda *shape: (rng.standard_normal(shape) * np.sqrt(2 / shape[0])).astype(np.float32)
        self.p = {"embed": (rng.standard_normal((256, EMBED)) * 0.5).astype(np.float32), "out": scale(FILTERS * len(WIDTHS), len(LANGUAGES)), "bias": np.zeros(len(LANGUAGES), np.float32)}
        for w in WIDTHS:
            self.p[f"f{w}"], self.p[f"b{w}"] = scale(w * EMBED, FILTERS), np.zeros(FILTERS, np.float32)

    def forward(self, x: np.ndarray, keep: dict | None = None, drop: np.ndarray | None = None) -> np.ndarray:
        pooled = []
        for w in WIDTHS:
            # A byte has one of 256 embeddings, so that each tap of each filter is a table; a response is a sum of lookups.
            taps, steps = self.p[f"f{w}"].reshape(w, EMBED, FILTERS), LENGTH - w + 1
            response = (self.p["embed"] @ taps[0] + self.p[f"b{w}"])[x[:, :steps]]
            for j in range(1, w):
                response += (self.p["embed"] @ taps[j])[x[:, j : j + steps]]
            if keep is None:
                pooled.append(np.maximum(response.max(axis=1), 0))
            else:
                keep[w] = at = response.argmax(axis=1)
                pooled.append(np.maximum(np.take_along_axis(response, at[:, None], axis=1)[:, 0], 0))
        features = np.concatenate(pooled, axis=1)
        if drop is not None:
            features = features * drop
        logits = features @ self.p["out"] + self.p["bias"]
        logits -= logits.max(axis=1, keepdims=True)
        probability = np.exp(logits)
        probability /= probability.sum(axis=1, keepdims=True)
        if keep is not None:
            keep["features"] = features
        return probability

    def gradients(self, x: np.ndarray, y: np.ndarray, drop: np.ndarray) -> dict[str, np.ndarray]:
        keep: dict = {}
        delta = self.forward(x, keep, drop)
        delta[np.arange(len(y)), y] -= 1
        delta /= len(y)
        features = keep["features"]
        grad = {"out": features.T @ delta, "bias": delta.sum(axis=0)}
        back = (delta @ self.p["out"].T) * (features > 0) * drop
        rows, onto = np.arange(len(x))[:, None], np.zeros((256, EMBED))
        for k, w in enumerate(WIDTHS):
            at, d = keep[w], back[:, k * FILTERS : (k + 1) * FILTERS]
            taps, into = self.p[f"f{w}"].reshape(w, EMBED, FILTERS), np.empty((w, EMBED, FILTERS), np.float32)
            for j in range(w):
                chosen = x[rows, at + j]
                into[j] = np.einsum("nfe,nf->ef", self.p["embed"][chosen], d)
                spread = (d[:, :, None] * taps[j].T[None]).reshape(-1, EMBED)
                for e in range(EMBED):
                    onto[:, e] += np.bincount(chosen.ravel(), spread[:, e], 256)
            grad[f"f{w}"], grad[f"b{w}"] = into.reshape(w * EMBED, FILTERS), d.sum(axis=0)
        return grad | {"embed": onto.astype(np.float32)}

    def train(self, x: np.ndarray, y: np.ndarray, seed: int = 11) -> None:
        rng, t = np.random.default_rng(seed), 0
        m, v = ({k: np.zeros_like(a) for k, a in self.p.items()} for _ in range(2))
        for epoch in range(EPOCHS):
            order, rate = rng.permutation(len(x)), STEP * 0.5**epoch
            for at in range(0, len(x), BATCH):
                pick, t = order[at : at + BATCH], t + 1
                drop = ((rng.random((len(pick), FILTERS * len(WIDTHS))) >= DROP) / (1 - DROP)).astype(np.float32)
                for k, g in self.gradients(x[pick], y[pick], drop).items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.p[k] -= (rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)

    def log_probabilities(self, parts: list[bytes]) -> np.ndarray:
        out = [np.log(self.forward(encode(parts[k : k + 64])) + 1e-9) for k in range(0, len(parts), 64)]
        return np.concatenate(out) if out else np.zeros((0, len(LANGUAGES)), np.float32)


def plain(text: str) -> str:
    return "".join(ch for ch in unicodedata.normalize("NFKD", text) if not unicodedata.combining(ch))


def sentences(text: str) -> Iterator[tuple[int, int]]:
    """Start and end of each sentence or line that has a letter."""
    start = 0
    for end, following in [*((m.start(), m.end()) for m in _BREAK.finditer(text)), (len(text), len(text))]:
        if any(ch.isalpha() for ch in text[start:end]):
            yield start, end
        start = following


def labelled(df: DataFrame, key: str, text: str, label: str, per_language: int = SAMPLE) -> DataFrame:
    """A bounded sample: per_language rows of each language, the least by a hash of their key."""
    order = Window.partitionBy("label").orderBy(F.xxhash64("key"), "key")
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(label).alias("label")).where(F.col(label).isin(*LANGUAGES) & F.col(text).isNotNull())
    return rows.withColumn("n", F.row_number().over(order)).where(F.col("n") <= per_language).drop("n")


def fit(sample: pd.DataFrame, seed: int = 5) -> Network | None:
    """Train on a sample with columns text and label; every language weighs the same. None without any labelled text."""
    rng, parts, y = np.random.default_rng(seed), [], []
    if not len(sample):
        return None
    per_class = max(LEAST, int(sample["label"].value_counts().max()) * PER_ROW)
    for code, language in enumerate(LANGUAGES):
        texts = sorted(sample.loc[sample["label"] == language, "text"])
        split = [[text[a:b] for a, b in sentences(text)] for text in texts]
        pool, first = [part for own in split for part in own], [own[0] for own in split if own]
        if not pool:
            continue
        for _ in range(per_class):
            source = first if rng.random() < FIRST else pool
            part = source[rng.integers(0, len(source))]
            cut = windows(plain(part) if rng.random() < 0.5 else part)
            parts.append(cut[rng.integers(0, len(cut))])
            y.append(code)
    if not parts:
        return None
    x, y = encode(parts), np.array(y)
    network = Network()
    network.train(x, y)
    p = np.concatenate([network.forward(x[k : k + 64]) for k in range(0, len(x), 64)])
    wrong = (p.argmax(axis=1) != y) & (p.max(axis=1) >= SURE)
    if 0 < wrong.mean() < 0.2:
        network = Network()
        network.train(x[~wrong], y[~wrong])
    return network


def _sequence(p: np.ndarray) -> np.ndarray:
    """The most likely languages of sentences in a row (Viterbi)."""
    logs, n = np.log(p + 1e-9), p.shape[1]
    change = np.where(np.eye(n, dtype=bool), np.log(1 - SWITCH), np.log(SWITCH / (n - 1)))
    score, back = logs[0], []
    for row in logs[1:]:
        step = score[:, None] + change
        back.append(step.argmax(axis=0))
        score = step.max(axis=0) + row
    path = [int(score.argmax())]
    for choice in reversed(back):
        path.append(int(choice[path[-1]]))
    return np.array(path[::-1])


def _parts(network: Network | None, texts: list[str | None]) -> list[list[dict] | None]:
    """Parts of each text: neighbouring sentences of one language, with offsets and mean confidence."""
    spans = [list(sentences(t)) if t is not None and network is not None else [] for t in texts]
    cut = [windows(t[a:b]) for t, own in zip(texts, spans) for a, b in own]
    logs = network.log_probabilities([w for ws in cut for w in ws]) if cut else np.zeros((0, len(LANGUAGES)))
    sizes = np.array([len(ws) for ws in cut], dtype=int)
    mean = np.add.reduceat(logs, np.cumsum(sizes) - sizes, axis=0) / sizes[:, None] if len(sizes) else np.zeros((0, len(LANGUAGES)))
    p = np.exp(mean - mean.max(axis=1, keepdims=True)) if len(sizes) else mean
    p = p / p.sum(axis=1, keepdims=True)
    out, at = [], 0
    for t, own in zip(texts, spans):
        parts: list[dict] = []
        if own:
            block = p[at : at + len(own)]
            for (a, b), code, row in zip(own, _sequence(block), block):
                language, sure = LANGUAGES[code], float(row[code])
                if parts and parts[-1]["lang"] == language:
                    last = parts[-1]
                    weight = last["char_end"] - last["char_start"]
                    last["confidence"] = (last["confidence"] * weight + sure * (b - a)) / (weight + b - a)
                    last["char_end"] = b
                else:
                    parts.append({"lang": language, "confidence": sure, "char_start": a, "char_end": b})
        at += len(own)
        out.append(parts if t is not None else None)
    return out


PART = "array<struct<lang:string,confidence:double,char_start:int,char_end:int>>"


def parts_of(network: Network | None, text: Column) -> Column:
    """The parts of a text by language; null for null, empty for a text without letters."""

    @F.pandas_udf(PART)
    def parts(values: pd.Series) -> pd.Series:
        texts = [v if isinstance(v, str) else None for v in values]
        return pd.Series([p for k in range(0, len(texts), 256) for p in _parts(network, texts[k : k + 256])], dtype=object)

    return parts(text)


def named_languages(label: Column) -> Column:
    """The languages that a label names, an array; empty if it names none. Regions and spelling do not matter."""
    words = F.split(F.regexp_replace(F.lower(F.translate(F.coalesce(label, F.lit("")), "áàâãäéêèëíîïóôõöúûüçñÁÀÂÃÉÊÍÓÔÕÚÇÑ", "aaaaaeeeeiiioooouuucnAAAAEEIOOOUCN")), r"[-_][a-z0-9]+", ""), "[^a-z]+")
    known = F.create_map(*[F.lit(x) for code, forms in LABELS.items() for form in forms.split() for x in (form, code)])
    return F.array_sort(F.array_distinct(F.array_compact(F.transform(words, lambda w: F.try_element_at(known, w)))))


def segmented(spark: SparkSession, sf: str) -> DataFrame:
    """publication with the parts of abstract and title_pt; the network is trained when this is called."""
    sample = labelled(table(spark, sf, "documents"), "doc_id", "text", "lang").select("text", "label").toPandas()  # bounded by SAMPLE
    network = fit(sample)
    rows = spread(table(spark, sf, "publication").select("document_id", "language", "abstract", "title_pt"))
    return rows.withColumn("a", parts_of(network, F.col("abstract"))).withColumn("t", parts_of(network, F.col("title_pt")))


def main_language(parts: Column) -> Column:
    """The language of the greatest confidence times length; null without parts. Ties go to the first of LANGUAGES."""
    place = F.create_map(*[F.lit(x) for pair in ((code, -i) for i, code in enumerate(LANGUAGES)) for x in pair])
    sizes = F.transform(parts, lambda p: F.struct((p["confidence"] * (p["char_end"] - p["char_start"])).alias("s"), place[p["lang"]].alias("o"), p["lang"].alias("l")))
    return F.array_max(sizes)["l"]


def found(spark: SparkSession, sf: str) -> DataFrame:
    rows = segmented(spark, sf).withColumn("langs", F.array_sort(F.array_distinct(F.transform("a", lambda p: p["lang"])))).withColumn("named", named_languages(F.col("language")))
    wrong = (F.size("langs") > 1) | (F.size("named") == 0) | (F.col("named") != F.col("langs"))
    abstracts = F.when(F.col("langs").isNotNull() & (F.size("langs") > 0) & wrong, F.col("langs")).otherwise(F.array().cast("array<string>"))
    title = main_language(F.col("t"))
    titles = F.when(title.isNotNull() & (title != "pt"), F.array(title)).otherwise(F.array().cast("array<string>"))
    cell = lambda name: lambda lang: F.struct(F.lit(name).alias("field_name"), lang.alias("lang"))
    cells = F.concat(F.transform(abstracts, cell("abstract")), F.transform(titles, cell("title_pt")))
    return rows.select("document_id", F.explode(cells).alias("c")).select("document_id", "c.field_name", "c.lang").distinct()


def segments(spark: SparkSession, sf: str) -> DataFrame:
    """Every part of every abstract and title, with its language and confidence."""
    rows = segmented(spark, sf)
    each = lambda name, c: rows.select("document_id", F.lit(name).alias("field_name"), F.posexplode(c).alias("part_no", "p"))
    return each("abstract", "a").unionByName(each("title_pt", "t")).select("document_id", "field_name", "part_no", "p.*")


QUERIES = {"p1_found": found, "p1_segments": segments}
ORACLES: dict[str, str] = {}
