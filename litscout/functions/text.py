"""Text normalisers as Column functions.

They differ on purpose (accents folded or not, entities unescaped or not) and are not unified.
Every function maps null to null.
"""

from __future__ import annotations

import html
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

NON_ASCII = r"[^\x00-\x7F]"


def _on_distinct(values: pd.Series, fn) -> pd.Series:
    """Apply fn once to each distinct value of an Arrow batch."""
    known = {v: fn(v) for v in values.dropna().unique()}
    return values.map(known).astype(object).where(values.notna(), None)


@F.pandas_udf(T.StringType())
def _nfkd_base(values: pd.Series) -> pd.Series:
    return _on_distinct(values, lambda v: "".join(ch for ch in unicodedata.normalize("NFKD", v) if not unicodedata.combining(ch)))


@F.pandas_udf(T.StringType())
def _unescape(values: pd.Series) -> pd.Series:
    return _on_distinct(values, html.unescape)


#: Latin letters with marks and their plain forms (fixed values). Text with no other letters beyond ASCII needs no Python.
MARKED = "ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝàáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
PLAIN = "AAAAAACEEEEIIIINOOOOOUUUUYaaaaaaceeeeiiiinooooouuuuyy"


def fold_accents(c: Column) -> Column:
    """Letters without their marks; the JVM does Latin-1, Python only what holds anything else."""
    done = F.translate(c, MARKED, PLAIN)
    return F.when(done.rlike(NON_ASCII), _nfkd_base(done)).otherwise(done)


#: What each character beyond ASCII becomes by compatibility decomposition, ASCII parts only, if that is not nothing.
_FOLDED = {chr(n): a for n in (*range(0x80, 0xD800), *range(0xE000, 0x20000)) if (a := unicodedata.normalize("NFKD", chr(n)).encode("ascii", "ignore").decode())}
_ONE = {ch: a for ch, a in _FOLDED.items() if len(a) == 1}
_SEVERAL = {ch: a for ch, a in _FOLDED.items() if len(a) > 1}


def ascii_fold(c: Column) -> Column:
    """NFKD and then ASCII only; other characters vanish. No Python: letters that become one letter are translated, those that
    become several (ligatures and the like) are looked up where there are any."""
    several = F.create_map(*[F.lit(x) for pair in _SEVERAL.items() for x in pair])
    spelled = F.array_join(F.transform(F.split(c, ""), lambda ch: F.coalesce(F.try_element_at(several, ch), ch)), "")
    done = F.translate(F.when(c.rlike(f"[{''.join(_SEVERAL)}]"), spelled).otherwise(c), "".join(_ONE), "".join(_ONE.values()))
    return F.when(c.rlike(NON_ASCII), F.regexp_replace(done, NON_ASCII, "")).otherwise(c)


def squeeze(c: Column) -> Column:
    """White space collapsed to single blanks and trimmed."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def blank_to_null(c: Column) -> Column:
    return F.when(F.trim(c) != "", F.trim(c))


def lookup_text(c: Column) -> Column:
    """Lower case, everything but a-z and digits to one blank. Accented letters become blanks: no folding here."""
    return F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " "))


def normalize_title(c: Column) -> Column:
    """ASCII-folded lower case words; empty becomes null."""
    return blank_to_null(lookup_text(ascii_fold(c)))


def match_key(c: Column) -> Column:
    """Key for label matching: ASCII-folded, a trailing bracket of at most ten characters dropped unless it says
    "unspecified", lower case words."""
    folded = F.trim(ascii_fold(c))
    inner = F.regexp_extract(folded, r"\(([^()]{1,10})\)$", 1)
    keep = (F.trim(F.lower(inner)) == "unspecified") | (inner == "")
    return lookup_text(F.when(keep, folded).otherwise(F.regexp_replace(folded, r"\s*\([^()]{1,10}\)$", "")))


def plain_match_key(value: str) -> str:
    """match_key of one value on the driver, for the few values of a request."""
    folded = unicodedata.normalize("NFKD", value).encode("ascii", "ignore").decode("ascii").strip()
    if (m := re.search(r"\(([^()]{1,10})\)$", folded)) and m[1].strip().lower() != "unspecified":
        folded = folded[: m.start()]
    return " ".join(re.findall("[a-z0-9]+", folded.lower()))


def identity_text(c: Column) -> Column:
    """HTML entities unescaped, lower case, everything but a-z and digits to one blank."""
    return lookup_text(F.when(c.contains("&"), _unescape(c)).otherwise(c))


def condition_key(c: Column) -> Column:
    """Lower case with white space collapsed."""
    return squeeze(F.lower(c))


def study_type_key(c: Column) -> Column:
    """Marks dropped, hyphens to blanks, lower case, white space collapsed."""
    return squeeze(F.regexp_replace(F.lower(fold_accents(c)), "-", " "))


def split_list(c: Column) -> Column:
    """Values between commas, semicolons and line breaks, trimmed, without empty ones."""
    return F.filter(F.transform(F.split(c, r"[,;\n]"), lambda v: F.trim(v)), lambda v: v != "")


def label_list(values: Column, first: str, second: str) -> Column:
    """Labels of an array of structs: the first field, else the second, empty ones left out, each once."""
    filled = lambda v, name: F.nullif(v[name], F.lit(""))
    return F.array_distinct(F.array_compact(F.transform(values, lambda v: F.coalesce(filled(v, first), filled(v, second)))))


def redact(text: Column, limit: int = 0) -> Column:
    """struct(sha256, chars, text) in place of a text: of the text only its first limit characters."""
    return F.when(text.isNotNull(), F.struct(F.sha2(text, 256).alias("sha256"), F.length(text).alias("chars"), F.substring(text, 1, limit).alias("text")))


def digit_runs(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(r"(\d+)"), F.lit(1))


def term_hits(c: Column, terms: list[str]) -> Column:
    """How many of the terms occur in the text, as substrings; each counts once."""
    low = F.lower(F.coalesce(c, F.lit("")))
    total = F.lit(0)
    for term in terms:
        total = total + low.contains(term).cast("int")
    return total


def token_estimate(c: Column) -> Column:
    """A fourth of the characters, rounded up, at least one."""
    return F.greatest(F.lit(1), F.ceil(F.length(c) / 4)).cast("bigint")


def safe_fragment(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, "[^A-Za-z0-9]+", "_"), F.lit("_"))


def clip(c: Column, width: int) -> Column:
    """At most width characters, cut at the last blank of those."""
    cut = F.regexp_extract(F.substring(c, 1, width), r"(?s)^(.*) ", 1)
    return F.when(F.length(c) <= width, c).when(cut != "", cut).otherwise(F.substring(c, 1, width))


def visible_text(c: Column) -> Column:
    """Markup to plain text: scripts, styles, comments and tags dropped, entities unescaped, white space collapsed."""
    t = F.regexp_replace(c, r"(?is)<(script|style)\b.*?</\1\s*>", " ")
    t = F.regexp_replace(t, r"(?s)<!--.*?-->|<[^>]*>", " ")
    return squeeze(F.when(t.contains("&"), _unescape(t)).otherwise(t))


_SENTENCE = re.compile(r"[^.!?]{20,700}[.!?]")
_SPAN = T.ArrayType(T.StructType([T.StructField("text", T.StringType()), T.StructField("char_start", T.IntegerType()), T.StructField("char_end", T.IntegerType())]))


@F.pandas_udf(_SPAN)
def sentence_spans(values: pd.Series) -> pd.Series:
    """Sentences of 20 to 700 characters with their offsets; null gives null, no sentence an empty array."""

    def spans(text):
        return [{"text": m.group().strip(), "char_start": m.start(), "char_end": m.end()} for m in _SENTENCE.finditer(text)]

    return values.map(spans, na_action="ignore").astype(object).where(values.notna(), None)
