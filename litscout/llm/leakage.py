"""Problem 7: evaluation texts that leaked into the corpus.

Method: a BM25 inverted index of the test items with block-max WAND; its terms are pairs of neighbouring words, since
the words alone are those of the whole field. Every corpus text is cut into overlapping passages of WINDOW words, so that
any MIN_WORDS words in a row lie wholly in one of them; each passage queries the index and gets all items above the
threshold, which is for each item the least score that a leaked passage of it can have (see Index._thresholds). A passage
whose pairs could not reach it together is passed over before. The whole text around each item retrieved is then aligned
with it word by word. Indexes of at most MAX_ITEMS items go to the tasks, one after the other if there are more items; the
corpus is read once for each, and only the runs found are shuffled.

A leak is a run of MIN_WORDS or more words of an item, in order, in which only single words are exchanged: at least
BETWEEN equal words stand between two exchanges, no exchange brings in another figure, and none changes a name (a site).
A run of fewer than CERTAIN words is similar wording about another case if another figure or name stands in the place of
the item's within ASIDE words of it, or if it is part of a longer run of another item, which that passage then is of.

Defined results: null and empty texts and items leak nothing. Items of fewer than MIN_WORDS words cannot be found.
Repeated rows give one row. Case, spacing, line breaks, hyphenation at line ends and punctuation are immaterial.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litscout.session import spread, table

MAX_ITEMS = 50_000  #: of one index; more items make several
WINDOW, STRIDE = 32, 16
MIN_WORDS = 10
BETWEEN = 2
CERTAIN = 20
ASIDE = 4  #: words beside a run in which another figure or name counts
LEFT = MIN_WORDS - 1 - 2 * ((MIN_WORDS - 1) // (BETWEEN + 1))  #: pairs that a leaked passage shares with its item, at least
K1, B = 1.2, 0.75
BLOCK = 16

_WORD = re.compile(r"[^\W_]+")
_HYPHEN = re.compile(r"(?<=\w)[-‐­]\s*\n\s*(?=\w)")


def words(text: str) -> list[str]:
    return _WORD.findall(_HYPHEN.sub("", text).lower())


def names(texts: list[str]) -> set[str]:
    """Words that the items write with a capital only, and that few items have: sites and the like."""
    capital, small = Counter(), set()
    for text in texts:
        found = _WORD.findall(text)
        small.update(w for w in found if w[0].islower())
        capital.update({w.lower() for w in found if w[0].isupper() and len(w) > 3})
    return {w for w, n in capital.items() if w not in small and n <= max(2, len(texts) // 20)}


class Index:
    """Postings of items in blocks, each with the greatest BM25 contribution of a term in it."""

    def __init__(self, items: list[tuple[int, str]]) -> None:
        self.ids = [i for i, _ in items]
        self.words = [words(t) for _, t in items]
        self.names = names([t for _, t in items])
        pairs = [Counter(zip(item, item[1:])) for item in self.words]
        mean = sum(map(len, self.words)) / max(1, len(self.words)) or 1.0
        df = Counter(w for item in pairs for w in item)
        postings: dict[tuple[str, str], list[tuple[int, float]]] = {}
        for at, item in enumerate(pairs):
            for w, tf in item.items():
                idf = math.log(1 + (len(items) - df[w] + 0.5) / (df[w] + 0.5))
                postings.setdefault(w, []).append((at, idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(self.words[at]) / mean))))
        # Contributions as shares of the item's threshold, so that one threshold, 1, holds for all items.
        least = self._thresholds(postings)
        #: term -> (items, contributions, greatest contribution, greatest of each block)
        self.terms = {}
        for w, own in postings.items():
            share = [c / least[at] for at, c in own]
            self.terms[w] = ([at for at, _ in own], share, max(share), [max(share[k : k + BLOCK]) for k in range(0, len(own), BLOCK)])
        self.places = [self._places(list(zip(item, item[1:]))) for item in self.words]
        self.threshold = 0.999

    @staticmethod
    def _places(pairs: list[tuple[str, str]]) -> dict[tuple[str, str], list[int]]:
        out: dict[tuple[str, str], list[int]] = {}
        for k, w in enumerate(pairs):
            out.setdefault(w, []).append(k)
        return out

    def _thresholds(self, postings: dict) -> list[float]:
        """The least score of a leaked passage of each item: over all its runs of MIN_WORDS words, the least telling of the
        pairs that remain when exchanges stand as close as they may."""
        out = []
        scores = {(w, at): c for w, own in postings.items() for at, c in own}
        for at, item in enumerate(self.words):
            pairs, least = list(zip(item, item[1:])), math.inf
            for k in range(len(item) - MIN_WORDS + 1):
                run = sorted(scores[w, at] for w in set(pairs[k : k + MIN_WORDS - 1]))
                least = min(least, sum(run[:LEFT]))
            out.append(least)
        return out

    def retrieve(self, tokens: list[str]) -> tuple[set[int], list[int]]:
        """Items that some passage of a text retrieves, and the places of the text's pairs that are terms."""
        terms = self.terms
        at = [k for k, w in enumerate(zip(tokens, tokens[1:])) if w in terms]
        most = [0.0, *accumulate(terms[tokens[k], tokens[k + 1]][2] for k in at)]
        out: set[int] = set()
        for start in range(0, max(1, len(tokens) - WINDOW + STRIDE), STRIDE) if len(at) >= LEFT else ():
            if most[bisect_left(at, start + WINDOW - 1)] - most[bisect_left(at, start)] >= self.threshold:
                out.update(self.search(tokens[start : start + WINDOW]))
        return out, at

    def search(self, passage: list[str]) -> list[int]:
        """All items whose BM25 score for the passage reaches the threshold, by block-max WAND."""
        lists = [[t[0][0], 0, *t] for w in set(zip(passage, passage[1:])) if (t := self.terms.get(w))]
        if sum(x[4] for x in lists) < self.threshold:
            return []
        found, theta = [], self.threshold
        while lists:
            lists.sort(key=lambda x: x[0])
            bound, pivot = 0.0, -1
            for k, x in enumerate(lists):
                bound += x[4]
                if bound >= theta:
                    pivot = k
                    break
            if pivot < 0:
                break
            item = lists[pivot][0]
            while pivot + 1 < len(lists) and lists[pivot + 1][0] == item:
                pivot += 1
            near = 0.0
            for x in lists[: pivot + 1]:  # the bound by blocks: those that hold the pivot item or come next to it
                at = x[1]
                while at < len(x[2]) and x[2][at] < item:
                    at += 1
                near += x[5][at // BLOCK] if at < len(x[2]) else 0.0
            if near >= theta and lists[0][0] == item:
                score = sum(x[3][x[1]] for x in lists[: pivot + 1])
                if score >= theta:
                    found.append(item)
                self._forward(lists, pivot, item + 1)
            else:
                self._forward(lists, pivot, item if near >= theta else item + 1)
            lists = [x for x in lists if x[0] >= 0]
        return found

    @staticmethod
    def _forward(lists: list, pivot: int, item: int) -> None:
        for x in lists[: pivot + 1]:
            while x[1] < len(x[2]) and x[2][x[1]] < item:
                x[1] += 1
            x[0] = x[2][x[1]] if x[1] < len(x[2]) else -1

    def runs(self, tokens: list[str], item: int, at: list[int]) -> set[tuple[int, int]]:
        """(start, end) of the leaked runs of an item in a whole text, whose terms are at the places at."""
        places, theirs, out = self.places[item], self.words[item], set()
        shifts = Counter(q - k for k in at for q in places.get((tokens[k], tokens[k + 1]), ()))
        for shift, n in shifts.items():
            if n >= LEFT:
                first, last = max(0, -shift), min(len(tokens), len(theirs) - shift)
                out.update((first + a, first + b) for a, b in self._side_by_side(tokens[first:last], theirs[first + shift : last + shift]))
        return out

    def _side_by_side(self, ours: list[str], theirs: list[str]) -> Iterator[tuple[int, int]]:
        """Runs of two texts of equal length that are laid side by side."""
        equal = [a == b for a, b in zip(ours, theirs)]
        inside = lambda k: 0 <= k < len(equal) and equal[k]
        other = [
            not same and (a.isdigit() and b.isdigit() or b in self.names and inside(k - 1) and inside(k + 1)) for k, (same, a, b) in enumerate(zip(equal, ours, theirs))
        ]
        start = 0
        while start < len(equal):
            if not equal[start]:
                start += 1
                continue
            p, end, since, exchange = start + 1, start + 1, 1, None
            while p < len(equal):
                if equal[p]:
                    since, end = since + 1, p + 1
                elif since < BETWEEN or ours[p].isdigit() or theirs[p] in self.names:
                    break
                else:
                    since, exchange = 0, exchange if exchange is not None else p
                p += 1
            length = end - start
            if length >= CERTAIN or length >= MIN_WORDS and not any(other[max(0, start - ASIDE) : end + ASIDE]):
                yield start, end
            # What follows the first exchange may start a longer run that this one could not join.
            start = max(start + 1, exchange + 1 if exchange is not None and p < len(equal) else end)


def runs(docs: DataFrame, key: str, text: str, index: Index) -> DataFrame:
    """(key, row, item_id, start, stop): the runs of items in each text, row being a hash of the text."""

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for k, row, value in zip(batch["key"], batch["row"], batch["text"]):
                tokens = words(value)
                items, at = index.retrieve(tokens)
                out.extend((k, row, index.ids[item], a, b) for item in items for a, b in index.runs(tokens, item, at))
            yield pd.DataFrame(out, columns=["key", "row", "item_id", "start", "stop"])

    kind = dict(docs.dtypes)[key]
    rows = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("row"), F.col(text).alias("text")).where("key is not null and text is not null")
    return spread(rows).mapInPandas(visit, f"key {kind}, row bigint, item_id bigint, start int, stop int")


def leaks(docs: DataFrame, key: str, text: str, indexes: Iterable[Index]) -> DataFrame:
    """(key, item_id) of each document and each item of which it holds a passage. The runs of one text are few: each has
    MIN_WORDS words at least."""
    found = None
    for index in indexes:
        found = runs(docs, key, text, index) if found is None else found.unionByName(runs(docs, key, text, index))
    own = found.groupBy("key", "row").agg(F.collect_set(F.struct("item_id", "start", "stop")).alias("runs"))
    size = lambda r: r["stop"] - r["start"]
    longer = lambda r: F.exists("runs", lambda o: (o["item_id"] != r["item_id"]) & (o["start"] <= r["start"]) & (o["stop"] >= r["stop"]) & (size(o) > size(r)))
    kept = F.filter("runs", lambda r: (size(r) >= CERTAIN) | ~longer(r))
    return own.select(F.col("key").alias(key), F.explode(F.array_distinct(F.transform(kept, lambda r: r["item_id"]))).alias("item_id")).distinct()


def read_items(spark: SparkSession, sf: str) -> list[Index]:
    """Indexes of all items, MAX_ITEMS in each."""
    rows = table(spark, sf, "benchmark").select("item_id", "text").where("item_id is not null and text is not null").distinct().orderBy("item_id", "text")
    out: list[list[tuple[int, str]]] = [[]]
    for r in rows.toLocalIterator():
        if len(out[-1]) == MAX_ITEMS:
            out.append([])
        out[-1].append((r["item_id"], r["text"]))
    return [Index(items) for items in out]


def found(spark: SparkSession, sf: str) -> DataFrame:
    return leaks(table(spark, sf, "documents"), "doc_id", "text", read_items(spark, sf))


QUERIES = {"p7_found": found}
ORACLES: dict[str, str] = {}
