"""Quoted evidence checked against texts, and facts extracted from them."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from litscout.functions.text import lookup_text, squeeze

TOLERANCE, LEAST_TOKENS = 0.8, 6


@F.pandas_udf(T.DoubleType())
def grounding_score(evidence: pd.Series, source: pd.Series) -> pd.Series:
    """Share of the evidence's word pairs, as often as they occur, that the source has. Evidence of one word counts as 0 or 1.
    A set is needed, which expressions lack: in them the work grows with the square of the text."""
    out = []
    for e, s in zip(evidence, source):
        if e is None or s is None:
            out.append(None)
            continue
        ours, theirs = e.split(" "), s.split(" ")
        if len(ours) < 2:
            out.append(float(e != "" and e in theirs))
            continue
        have = set(zip(theirs, theirs[1:]))
        out.append(sum(p in have for p in zip(ours, ours[1:])) / (len(ours) - 1))
    return pd.Series(out, dtype="float64")


def grounding(evidence: Column, source: Column) -> Column:
    """struct(exact, score, status) of normalised texts: exact, tolerant or review. The pairs are only made where the evidence
    is not contained as it stands."""
    e, s = lookup_text(evidence), lookup_text(source)
    exact = s.contains(e) & (e != "")
    score = F.when(exact, 1.0).otherwise(F.round(grounding_score(e, s), 4))
    long_enough = F.size(F.split(e, " ")) >= LEAST_TOKENS
    status = F.when(exact, "exact").when(long_enough & (score >= TOLERANCE), "tolerant").otherwise("review")
    return F.struct(exact.alias("exact"), score.alias("score"), status.alias("status"))


def weighted_score(components: dict[str, tuple[Column, float]], penalty: Column, bands: tuple[tuple[str, float], ...]) -> Column:
    """struct(score, band): components clamped to 0..1 and rounded to four decimals before they are weighted."""
    one = lambda c: F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), c.cast("double"))), 4)
    total = sum((one(c) * w for c, w in components.values()), F.lit(0.0)) - penalty
    score = F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), total)), 4)
    band = F.lit("low")
    for name, least in sorted(bands, key=lambda b: b[1]):
        band = F.when(score >= least, name).otherwise(band)
    return F.struct(score.alias("score"), band.alias("band"))


def all_rules(text: Column, rules: list[tuple[str, list[str]]]) -> Column:
    """Names of all rules of which a phrase occurs in whole words, in the order of the rules."""
    return F.array_compact(F.array(*[first_rule(text, [rule]) for rule in rules]))


def first_rule(text: Column, rules: list[tuple[str, list[str]]]) -> Column:
    """Name of the first rule of which a phrase occurs in whole words; null if none does."""
    padded = F.concat(F.lit(" "), lookup_text(text), F.lit(" "))
    hit = lambda phrases: F.greatest(*[padded.contains(f" {p} ") for p in phrases]) if len(phrases) > 1 else padded.contains(f" {phrases[0]} ")
    return F.coalesce(*[F.when(hit(phrases), F.lit(name)) for name, phrases in rules])


def repair_values(values: Column, allowed: list[str], renamed: dict[str, str]) -> Column:
    """struct(kept, dropped): known other spellings renamed, values outside the closed set dropped, each once, and listed."""
    mapping = F.create_map(*[F.lit(x) for pair in renamed.items() for x in pair]) if renamed else F.create_map(F.lit(""), F.lit(""))
    named = F.transform(values, lambda v: F.coalesce(F.try_element_at(mapping, v), v))
    closed = F.array(*[F.lit(v) for v in allowed])
    return F.struct(F.array_distinct(F.filter(named, lambda v: F.array_contains(closed, v))).alias("kept"), F.array_distinct(F.array_except(named, closed)).alias("dropped"))


# What is counted in a study, by the scope of the count, and number words.
SCOPES = {
    "patients": "patients?", "participants": "participants?|subjects?|individuals?|volunteers?", "animals": "mice|rats?|animals?", "included_studies": "articles?|studies", "records_or_charts": "records?|charts?",
    "cells_or_samples": "cells?|samples?",
}
UNITS = {w: n for n, w in enumerate("one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split(), 1)}
TENS = {w: 10 * n for n, w in enumerate("twenty thirty forty fifty sixty seventy eighty ninety".split(), 2)}
YEARS = range(1800, 2036)  #: such figures are years, not counts
MOST_SIZES = 20

_COUNT = r"(?P<n>\d{1,3}(?:,\d{3})*|\d{1,8})"
_NOUN = f"(?P<of>{'|'.join(SCOPES.values())})"
_WORDED = f"(?P<n>(?:{'|'.join(TENS)})(?:[- ](?:{'|'.join(list(UNITS)[:9])}))?|{'|'.join(UNITS)})"
_SIZES = [
    (re.compile(p, re.I), method)
    for p, method in (
        (rf"\b{_COUNT}\s+{_NOUN}\b", "figure"), (rf"\b{_NOUN}\s*\(\s*n\s*=\s*{_COUNT}\s*\)", "figure"),
        (rf"\b{_NOUN}\s+(?:were|was)\s+(?:included|enrolled|randomi[sz]ed|analy[sz]ed)\s*[:;,]?\s*(?:n\s*=\s*)?{_COUNT}\b", "figure"),
        (rf"\b(?:total\s+)?sample\s+(?:size\s+of|consisted\s+of)\s+{_COUNT}\b", "figure"), (rf"\b{_WORDED}\s+{_NOUN}\b", "word"),
    )
]
_RANDOMISED, _ARM = re.compile(r"[^.!?]{0,250}\brandomi[sz]ed\b[^.!?]{0,350}"), re.compile(r"\bn\s*=\s*(\d{1,5})\b", re.I)
_SCOPE = [(scope, re.compile(f"(?:{nouns})$", re.I)) for scope, nouns in SCOPES.items()]
_SIZE = T.ArrayType(T.StructType([T.StructField(n, k) for n, k in (("count", T.LongType()), ("scope", T.StringType()), ("method", T.StringType()), ("char_start", T.IntegerType()), ("char_end", T.IntegerType()))]))


def _value(text: str) -> int:
    """The number that figures or number words stand for."""
    if text[0].isdigit():
        return int(text.replace(",", ""))
    return sum(TENS.get(w) or UNITS[w] for w in re.split("[- ]", text.lower()))


@F.pandas_udf(_SIZE)
def sample_sizes(values: pd.Series) -> pd.Series:
    """Counts of what a study is of, with scope, method and place: figures beside a noun, number words, and sums of the arms of a
    randomised design. The first of each (count, scope) stands, MOST_SIZES at most; figures that may be years are left out. The
    offsets need Python; null gives null."""

    def find(text):
        out = {}
        for pattern, method in _SIZES:
            for m in pattern.finditer(text):
                count, noun = _value(m["n"]), m.groupdict().get("of")
                if count > 0 and (method == "word" or count not in YEARS):
                    scope = next((s for s, p in _SCOPE if p.match(noun)), "unknown") if noun else "unknown"
                    out.setdefault((count, scope), (method, m.start(), m.end()))
        for m in _RANDOMISED.finditer(text):
            arms = [int(n) for n in _ARM.findall(m.group())]
            if len(arms) > 1:
                out.setdefault((sum(arms), "participants"), ("arms", m.start(), m.end()))
        return [{"count": c, "scope": s, "method": how, "char_start": x, "char_end": y} for (c, s), (how, x, y) in list(out.items())[:MOST_SIZES]]

    return values.map(find, na_action="ignore").astype(object).where(values.notna(), None)


def label_forms(label: str) -> list[str]:
    """Ways in which a label may stand in a text, the longest first: itself, what its brackets hold, without brackets, without
    dashes, and its last two long words in reverse order; none shorter than three characters."""
    flat = lambda v: " ".join(v.split())
    forms = {flat(label), flat(re.sub(r"\([^)]*\)", " ", label)), flat(label.replace(" - ", " ")), *(flat(v) for v in re.findall(r"\(([^)]+)\)", label))}
    long = [w for w in re.split("[^A-Za-z0-9]+", label) if len(w) >= 5]
    if len(long) > 1:
        forms.add(f"{long[-1]} {long[-2]}")
    return sorted((f for f in forms if len(f) >= 3), key=lambda f: (-len(f), f))


_LOCATED = T.ArrayType(T.StructType([T.StructField("label", T.StringType()), T.StructField("text", T.StringType()), T.StructField("char_start", T.IntegerType()), T.StructField("char_end", T.IntegerType())]))


def locate_labels(text: Column, labels: Column, most: int = 4) -> Column:
    """The sentences that show labels: for each form of each label the first sentence not taken yet that holds it as whole words,
    most in all. Offsets need Python."""
    from litscout.functions.text import _SENTENCE

    @F.pandas_udf(_LOCATED)
    def locate(texts: pd.Series, wanted: pd.Series) -> pd.Series:
        out = []
        for t, ls in zip(texts, wanted):
            spans = [(m.start(), m.end(), m.group().strip()) for m in _SENTENCE.finditer(t)] if t is not None else []
            taken: dict[tuple[int, int], dict] = {}
            for label in ls if ls is not None else ():
                for form in label_forms(label or ""):
                    whole = re.compile(rf"\b{re.escape(form)}\b", re.I)
                    at = next(((a, b, s) for a, b, s in spans if (a, b) not in taken and whole.search(s)), None)
                    if at and len(taken) < most:
                        taken[at[:2]] = {"label": label, "text": at[2], "char_start": at[0], "char_end": at[1]}
            out.append(list(taken.values()))
        return pd.Series(out, dtype=object)

    return locate(text, labels)


def best_sentences(sentences: Column, families: list[str], bonus: str, most: int = 4) -> Column:
    """Of sentences (structs with text and char_start) those with a hit of a family of patterns: most hits first, one more for the
    bonus pattern, then by place."""
    hits = lambda s: sum((F.size(F.regexp_extract_all(s["text"], F.lit(f"(?i){p}"), F.lit(0))) for p in families), F.lit(0))
    rated = F.filter(F.transform(sentences, lambda s: F.struct((-hits(s) - s["text"].rlike(f"(?i){bonus}").cast("int")).alias("rank"), s["char_start"].alias("char_start"), s["text"].alias("text"), hits(s).alias("hits"))), lambda r: r["hits"] > 0)
    return F.slice(F.array_sort(rated), 1, most)


def guardrail_states(candidate: Column, baseline: Column) -> Column:
    """How the values of a candidate and of a baseline, both arrays, agree: both_empty, candidate_only, baseline_only, agree,
    overlap or disagree."""
    empty = lambda c: F.size(F.coalesce(c, F.array().cast("array<string>"))) == 0
    return (
        F.when(empty(candidate) & empty(baseline), "both_empty").when(empty(baseline), "candidate_only").when(empty(candidate), "baseline_only")
        .when((F.size(F.array_except(candidate, baseline)) == 0) & (F.size(F.array_except(baseline, candidate)) == 0), "agree").when(F.arrays_overlap(candidate, baseline), "overlap").otherwise("disagree")
    )


def around(text: Column, pattern: str, width: int = 120) -> Column:
    """The first match of a pattern with width characters on either side, white space collapsed; null without one."""
    at = F.regexp_instr(text, F.lit(pattern))
    start = F.greatest(F.lit(1), at - width)
    return F.when(at > 0, squeeze(F.substring(text, start, at - start + width + F.length(F.regexp_extract(text, pattern, 0)))))


def cut_references(text: Column, least: int = 5000, most: int | None = 60000) -> Column:
    """Text up to its list of references, if that starts after the first least characters, and most characters of it (all: None).
    The word "references" is looked for first, and "bibliography" only where there is none."""
    low = F.lower(text)
    places = [F.nullif(F.locate(marker, low, least + 1), F.lit(0)) for marker in (" references ", " bibliography ")]
    end = F.coalesce(*places)
    out = F.when(end.isNotNull(), F.substring(text, F.lit(1), end - 1)).otherwise(text)
    return out if most is None else F.substring(out, F.lit(1), F.lit(most))


def rules_prefix(text: Column, is_html: Column, most: int = 250_000, least: int = 2_000) -> Column:
    """The part of a text that rules look at: white space collapsed, most characters, up to the earlier of the two headings of a
    list of references if that starts after the first least characters; pages in HTML keep theirs."""
    flat = F.substring(squeeze(text), 1, most)
    low = F.lower(flat)
    end = F.least(*[F.nullif(F.locate(marker, low, least + 1), F.lit(0)) for marker in (" references ", " bibliography ")])
    return F.when(end.isNotNull() & ~F.coalesce(is_html, F.lit(False)), F.substring(flat, F.lit(1), end - 1)).otherwise(flat)
