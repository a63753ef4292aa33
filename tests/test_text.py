from pyspark.sql import functions as F

from litscout.functions import ids
from litscout.functions import text as tx


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "v string").select(fn(F.col("v")).alias("r")).first()["r"]


def test_match_key_drops_short_brackets_but_not_unspecified(spark):
    assert one(spark, "  Múltiple Sclerosis (MS) ", tx.match_key) == "multiple sclerosis"
    assert one(spark, "pain (unspecified)", tx.match_key) == "pain unspecified"
    assert one(spark, None, tx.match_key) is None


def test_folding_beyond_latin_1_uses_the_fallback(spark):
    assert one(spark, "ſtrāße ﬁn", tx.ascii_fold) == "strae fin"
    assert one(spark, "Ångström", tx.fold_accents) == "Angstrom"
    assert one(spark, "řeka", tx.fold_accents) == "reka"


def test_lookup_text_turns_accents_to_blanks(spark):
    assert one(spark, "Café-Crème 2", tx.lookup_text) == "caf cr me 2"
    assert one(spark, "", tx.lookup_text) == ""


def test_markup(spark):
    assert one(spark, "<p>a &amp; b</p><script>x()</script><!-- c -->d", tx.visible_text) == "a & b d"
    assert one(spark, "R&amp;D", tx.identity_text) == "r d"


def test_clip_cuts_at_a_blank(spark):
    assert one(spark, "aaaa bbbb cccc", lambda c: tx.clip(c, 11)) == "aaaa bbbb"
    assert one(spark, "short", lambda c: tx.clip(c, 11)) == "short"
    assert one(spark, "x" * 30, lambda c: tx.clip(c, 11)) == "x" * 11


def test_sentences_with_offsets(spark):
    text = "This sentence is long enough. Short. Another sentence of some length!"
    found = one(spark, text, tx.sentence_spans)
    assert [text[s["char_start"] : s["char_end"]].strip() for s in found] == [s["text"] for s in found]
    assert one(spark, None, tx.sentence_spans) is None


def test_lists_and_tokens(spark):
    assert one(spark, "a, b;c\n ,", tx.split_list) == ["a", "b", "c"]
    assert one(spark, "abcde", tx.token_estimate) == 2
    assert one(spark, "Aspirin and aspirin", lambda c: tx.term_hits(c, ["aspirin", "and", "x"])) == 2


def test_identifiers(spark):
    of = lambda kind, v: one(spark, v, lambda c: ids.identifier(kind, c))
    assert tuple(of("pmid", "PMID:0012345")) == ("0012345", "trim_prefix_and_slash.v1") and of("pmid", "https://pubmed.ncbi.nlm.nih.gov/123456/")["value"] == "123456"
    assert of("pmid", "PMID: 12345") is None and of("pmid", "1234") is None
    assert tuple(of("pmcid", "https://pmc.ncbi.nlm.nih.gov/articles/pmc77/")) == ("PMC77", "uppercase_and_trim_route.v1") and of("pmcid", "77") is None
    assert tuple(of("doi", "https://dx.doi.org/10.1000/AB.c).")) == ("10.1000/ab.c", "lowercase_and_trim_punctuation.v1") and of("doi", "10.1000%2Fa+b")["value"] == "10.1000/a+b"
    assert tuple(of("doi", "10.3389/FX.1/full?x=1")) == ("10.3389/fx.1", "frontiers_full_route_suffix.v1") and of("doi", "10.1000/x/full")["value"] == "10.1000/x/full"
    assert one(spark, "x", lambda c: ids.stable_id(F.lit(None).cast("string"), c, c, c, c, c)) == "publication:pmcid:x"
    assert one(spark, "none", lambda c: ids.identifier("doi", c)) is None
    assert one(spark, "HTTPS://Www.X.Example:80/A/b/?q=1#f", ids.canonical_url) == "https://www.x.example:80/A/b?q=1"
    assert one(spark, "HTTPS://Www.X.Example:80/A", ids.url_host) == "x.example"


def test_record_hash_equals_json(spark):
    import hashlib
    import json

    row = {"b": 'quote " and \\', "a": "x"}
    made = spark.createDataFrame([(row["a"], row["b"])], "a string, b string").select(ids.record_hash({"b": F.col("b"), "a": F.col("a")})).first()[0]
    assert made == hashlib.sha256(json.dumps(row, sort_keys=True).encode()).hexdigest()[:24]


def test_ascii_folding_equals_decomposition(spark):
    import unicodedata

    values = ["Ærø ﬁne Ⅳ ½ ㎏ Ħ ő ş Ǽ", "naïve—café", "漢字 ß ﷺ", "plain", "", "".join(chr(n) for n in range(0xA0, 0x250)), "".join(chr(n) for n in range(0x1D400, 0x1D480)), "e\u0301"]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v string").select(tx.ascii_fold(F.col("v"))).collect()]
    assert got == [unicodedata.normalize("NFKD", v).encode("ascii", "ignore").decode() for v in values]


def test_plain_match_key_equals_match_key(spark):
    values = ["Dor crônica (DC)", "Pain (unspecified)", "x (a very long bracket)", " A-b  c ", "(abc)", "é (İ)"]
    assert [one(spark, v, tx.match_key) for v in values] == [tx.plain_match_key(v) for v in values]
