"""Registered text queries over all documents, against brute force in Python."""

import hashlib
import html
import re

from pyspark.sql import functions as F

from litscout.operators import evidence
from litscout.plans import catalog

TEXTS = [
    "plain text\nof two lines", "Dor crônica, <b>señal</b> &amp; r&eacute;sum&eacute; &#8211; 5&nbsp;mg", "a<br/>b <!-- <i>not</i> seen --> c", "<style>p {x: y}</style>seen<SCRIPT type='a'>\nlet a = 1 < 2;\n</SCRIPT >after",
    "wide   blanks　here", "&lt;b&gt; stays &amp;amp; as text", "Größe ≤ 5 μm", "", None,
]


def visible(text):
    marked = "<p>" + text.replace("\n", "</p><p>") + "</p><script>x</script>"
    marked = re.sub(r"<(script|style)\b.*?</\1\s*>", " ", marked, flags=re.I | re.S)
    return " ".join(html.unescape(re.sub(r"<!--.*?-->|<[^>]*>", " ", marked, flags=re.S)).split())


def test_visible_text_of_all_documents(spark, tables):
    sf = tables(documents=(list(enumerate(TEXTS)), "doc_id bigint, text string"))
    got = {r["doc_id"]: r["hash"] for r in catalog.QUERIES["visible_text"](spark, sf).collect()}
    assert got == {i: None if t is None else hashlib.md5(visible(t).encode()).hexdigest() for i, t in enumerate(TEXTS)}
    assert visible(TEXTS[1]) == "Dor crônica, señal & résumé – 5 mg" and visible(TEXTS[2]) == "a b c" and visible(TEXTS[3]) == "seen after"


def test_references_are_cut(spark):
    long = "Some words. " * 6000
    texts = [long, f"{long} References {long}", f"{'x ' * 3000} bibliography y", f"{'x ' * 3000} bibliography y references z", "early references stay", None]
    whole = [long, long, "x " * 3000, f"{'x ' * 3000} bibliography y", "early references stay", None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", evidence.cut_references(F.col("t"), most=None).alias("c"), evidence.cut_references(F.col("t")).alias("p"))
    got = {r["i"]: (r["c"], r["p"]) for r in df.collect()}
    assert got == {i: (t, None if t is None else t[:60000]) for i, t in enumerate(whole)}
