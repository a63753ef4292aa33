"""Identifiers and addresses as Column functions. The cleaners differ on purpose and are not unified."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _or_null(c: Column, valid: Column) -> Column:
    return F.when(valid, c)


#: Grammar of the identifiers, prefixes they come with, and addresses that hold them (fixed values).
FORMS = {"pmid": r"^\d{5,9}$", "pmcid": r"(?i)^PMC\d+$", "doi": r"(?i)^10\.\d{4,9}/\S+$"}
PREFIXES = {"pmid": r"(?i)^(?:PMID:|https?://pubmed\.ncbi\.nlm\.nih\.gov/)", "pmcid": r"(?i)^https?://pmc\.ncbi\.nlm\.nih\.gov/articles/", "doi": r"(?i)^https?://(?:dx\.)?doi\.org/"}
RULES = {"pmid": "trim_prefix_and_slash.v1", "pmcid": "uppercase_and_trim_route.v1", "doi": "lowercase_and_trim_punctuation.v1", "route": "frontiers_full_route_suffix.v1"}
ADDRESSES = {"pmid": r"(?i)pubmed\.ncbi\.nlm\.nih\.gov/(\d{5,9})(?:/|$)", "pmcid": r"(?i)(?:articles/|identifier=oai:pubmedcentral\.nih\.gov:)(PMC?\d+)", "doi": r"(?i)doi\.org/(10\.\d{4,9}/[^?#\s]+)"}
ROUTE = r"(?i)^(10\.3389/[^?#\s]+?)/full(?:[?#].*)?$"
MACHINE = r"/api/oai/|webservices/rest|api\.openalex\.org"


def identifier(kind: str, c: Column) -> Column:
    """struct(value, rule): a PMID, PMCID or DOI in its plain form and the rule that made it so; null if it is none."""
    raw = F.trim(F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c))
    raw = F.regexp_replace(F.regexp_replace(raw, "^[<>\"']+|[<>\"']+$", ""), PREFIXES[kind], "")
    rule = F.lit(RULES[kind])
    if kind == "doi":
        low = F.lower(raw)
        route = F.regexp_extract(low, ROUTE, 1)
        value = F.when(route != "", route).otherwise(F.regexp_replace(low, r"[.,;)]+$", ""))
        rule = F.when(route != "", RULES["route"]).otherwise(rule)
    else:
        value = F.regexp_replace(raw, "/+$", "")
        value = F.upper(value) if kind == "pmcid" else value
    return _or_null(F.struct(value.alias("value"), rule.alias("rule")), value.rlike(FORMS[kind]))


def from_address(kind: str, url: Column) -> Column:
    """The identifier that an address holds, as it stands there (a PMCID with its letters); null without one."""
    found = F.nullif(F.regexp_extract(F.coalesce(F.try_url_decode(F.replace(url, F.lit("+"), F.lit("%2B"))), url), ADDRESSES[kind], 1), F.lit(""))
    return F.when(F.upper(found).startswith("PMC"), found).otherwise(F.concat(F.lit("PMC"), found)) if kind == "pmcid" else found


def from_article(kind: str, text: Column) -> Column:
    """array<struct(value, method)>: identifiers in an article's own metadata: article-id elements inside article-meta, and
    citation meta tags in either order of attributes."""
    meta = F.regexp_extract(text, r"(?is)<article-meta\b.*?</article-meta>", 0)
    of = lambda values, method: F.transform(values, lambda v: F.struct(v.alias("value"), F.lit(method).alias("method")))
    every = lambda t, pattern: F.regexp_extract_all(t, F.lit(pattern), F.lit(1))
    return F.concat(
        of(every(meta, rf"(?i)<article-id[^>]+pub-id-type=[\"']{kind}[\"'][^>]*>([^<]+)"), "nxml_article_id"),
        of(every(text, rf"(?i)<meta[^>]+name=[\"']citation_{kind}[\"'][^>]+content=[\"']([^\"']+)"), "html_citation_meta"),
        of(every(text, rf"(?i)<meta[^>]+content=[\"']([^\"']+)[\"'][^>]+name=[\"']citation_{kind}[\"']"), "html_citation_meta"),
    )


def identity_urls(pmid: Column, pmcid: Column, doi: Column, canonical: Column, source: Column) -> Column:
    """array<struct(url_kind, url, for_readers)>: addresses made from identifiers, then the given ones that are not among those;
    interfaces for machines are not for readers."""
    row = lambda kind, url, human: F.when(url.isNotNull() & (url != ""), F.struct(F.lit(kind).alias("url_kind"), url.alias("url"), human.alias("for_readers")))
    made = [row("pmc_full_text", F.concat(F.lit("https://pmc.ncbi.nlm.nih.gov/articles/"), pmcid, F.lit("/")), F.lit(True)), row("pubmed", F.concat(F.lit("https://pubmed.ncbi.nlm.nih.gov/"), pmid, F.lit("/")), F.lit(True)), row("doi", F.concat(F.lit("https://doi.org/"), doi), F.lit(True))]
    given = [row("canonical", canonical, ~canonical.rlike(MACHINE)), row("source", source, ~source.rlike(MACHINE))]
    rows = F.array_compact(F.array(*made, *given))
    return F.filter(rows, lambda r, i: (i == 0) | ~F.exists(F.slice(rows, F.lit(1), i), lambda o: o["url"] == r["url"]))


def preferred_url(urls: Column) -> Column:
    """struct(url_kind, url) of the first address for readers; identity_urls has them in the order of preference."""
    best = F.try_element_at(F.filter(urls, lambda u: u["for_readers"]), F.lit(1))
    return F.when(best.isNotNull(), F.struct(best["url_kind"].alias("url_kind"), best["url"].alias("url")))


def trimmed_doi(c: Column) -> Column:
    """Lower case without blanks around and closing punctuation."""
    return F.lower(F.regexp_replace(F.trim(c), r"[).,;\]]+$", ""))


def trimmed_pmcid(c: Column) -> Column:
    return F.upper(F.trim(c))


def trimmed_url(c: Column) -> Column:
    """Without blanks around and closing slashes; null for empty."""
    return F.nullif(F.regexp_replace(F.trim(c), "/+$", ""), F.lit(""))


def clean_doi(c: Column) -> Column:
    """Lower case without a resolver or doi: prefix and closing punctuation; nothing is checked."""
    return F.nullif(F.rtrim(F.regexp_replace(F.lower(F.trim(c)), r"^(?:https?://(?:dx\.)?doi\.[a-z]+/|doi:\s*)", ""), F.lit(".,; ")), F.lit(""))


def canonical_url(c: Column) -> Column:
    """Scheme and host in lower case, no fragment, no closing slash; null if there is no host."""
    parts = r"(?i)^\s*([a-z][a-z0-9+.-]*)://([^/?#\s]+)([^?#\s]*)(\?[^#\s]*)?"
    scheme, host = F.lower(F.regexp_extract(c, parts, 1)), F.lower(F.regexp_extract(c, parts, 2))
    path, query = F.regexp_replace(F.regexp_extract(c, parts, 3), "/+$", ""), F.regexp_extract(c, parts, 4)
    return F.when(host != "", F.concat(scheme, F.lit("://"), host, path, query))


def url_host(c: Column) -> Column:
    """Host in lower case without www. and port."""
    host = F.lower(F.regexp_extract(c, r"(?i)^\s*[a-z][a-z0-9+.-]*://([^/?#:\s]+)", 1))
    return F.nullif(F.regexp_replace(host, r"^www\.", ""), F.lit(""))


def short_hash(c: Column, digits: int = 16) -> Column:
    return F.substring(F.sha2(c, 256), 1, digits)


def stable_id(pmid: Column, pmcid: Column, doi: Column, url: Column, title: Column, fallback: Column) -> Column:
    """One id by the strongest identifier there is; DOIs, addresses and titles as hashes."""
    named = lambda prefix, c: F.concat(F.lit(prefix), c)
    made = F.coalesce(named("pmid:", pmid), named("pmcid:", pmcid), named("doi:", short_hash(doi)), named("url:", short_hash(url)), named("title:", short_hash(title)), named("legacy:", fallback))
    return F.concat(F.lit("publication:"), made)


def record_hash(columns: dict[str, Column], digits: int = 24) -> Column:
    """Hash of a JSON object with sorted keys and string values, spaced as Python's json module does it."""
    quote = lambda c: F.concat(F.lit('"'), F.regexp_replace(F.regexp_replace(c, r"\\", r"\\\\"), '"', r'\\"'), F.lit('"'))
    pairs = [F.concat(F.lit(f'"{k}": '), F.coalesce(quote(v.cast("string")), F.lit("null"))) for k, v in sorted(columns.items())]
    return short_hash(F.concat(F.lit("{"), F.concat_ws(", ", *pairs), F.lit("}")), digits)


def bounded_year(c: Column, low: int = 1800, high: int = 2100) -> Column:
    year = c.try_cast("int")
    return F.when(year.between(low, high), year)


def loose_boolean(c: Column) -> Column:
    word = F.lower(F.trim(c))
    return F.when(word.isin("y", "yes", "true", "t", "1"), True).when(word.isin("n", "no", "false", "f", "0"), False)


def first_page(urls: list[tuple[str, Column]]) -> Column:
    """struct(kind, url) of the first address present, in the order given."""
    return F.coalesce(*[F.when(u.isNotNull(), F.struct(F.lit(k).alias("kind"), u.alias("url"))) for k, u in urls])


def redact_fields(c: Column, kind: T.DataType, names: set[str]) -> Column:
    """A value of any type with the strings in fields of these names replaced by a hash, however deep they are."""
    if isinstance(kind, T.StructType):
        fields = []
        for f in kind.fields:
            own = c[f.name]
            hidden = f.name in names and isinstance(f.dataType, T.StringType)
            fields.append((F.concat(F.lit("sha256:"), F.sha2(own, 256)) if hidden else redact_fields(own, f.dataType, names)).alias(f.name))
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda v: redact_fields(v, kind.elementType, names))
    if isinstance(kind, T.MapType):
        return F.transform_values(c, lambda k, v: F.when(k.isin(*names), F.concat(F.lit("sha256:"), F.sha2(v, 256))).otherwise(v) if isinstance(kind.valueType, T.StringType) else redact_fields(v, kind.valueType, names))
    return c


def payload_record(payload: Column) -> list[Column]:
    """Columns of a stored payload: its bytes' hash and size."""
    return [F.sha2(payload, 256).alias("payload_sha256"), F.octet_length(payload).cast("bigint").alias("payload_size_bytes")]
