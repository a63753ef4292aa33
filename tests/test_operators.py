import pytest
from pyspark.sql import functions as F

from litscout.operators import aggregates, evidence, index, joins, merge, search, windows
from litscout.sources import readers, writers


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


@pytest.fixture
def docs(spark):
    data = [(1, "Oral drug for insomnia. Other text.", 2020, ["Insomnia (X)", "pain"]), (2, "insomnia and pain drug", None, ["insomnia"]), (3, None, 2021, None)]
    df = spark.createDataFrame(data, "document_id int, body string, publication_year int, topics array<string>")
    return df.withColumn("search_text", index.search_text([F.col("body")]))


def test_terms_and_underscore():
    assert search.terms("The drug of a drug for x Insomnia a_b") == ["drug", "insomnia", "a_b"]
    assert search.terms("of the") == []


def test_search_filters_and_pages(docs):
    facets = index.facet_rows(docs, {"topic": F.col("topics")})
    request = search.Request(query="insomnia drug", filters={"topic": search.Filter(("insomnia", "pain"), all_of=True)})
    page, envelope = search.search(docs, facets, request, "b1")
    assert rows(page, "document_id") == [(1,)] and envelope["total"] == 1 and envelope["next"] is None
    assert rows(search.select(docs, facets, search.Request(query="insomnia", year_from=2020)), "document_id") == [(1,)]
    page, envelope = search.search(docs, facets, search.Request(query="insomnia", limit=1), "b1")
    assert envelope["total"] == 2 and search.decode_cursor(envelope["next"], "b1") == 1
    with pytest.raises(ValueError):
        search.decode_cursor(envelope["next"], "b2")
    with pytest.raises(ValueError):
        search.decode_cursor("???", "b1")
    assert search.search(docs, facets, search.Request(query="of the"))[1]["total"] in (2, 3)


def test_request_limits():
    for bad in (dict(limit=0), dict(limit=51), dict(year_from=2001, year_to=2000), dict(filters={"a": search.Filter(tuple(map(str, range(51))))})):
        with pytest.raises(ValueError):
            search.Request(**bad)


def test_aliases_filter_but_do_not_count(docs):
    facets = index.facet_rows(docs, {"topic": F.col("topics")}, {"topic": F.array(F.struct(F.lit("alias").alias("alias"), F.lit("insomnia").alias("display")))})
    assert search.with_facets(docs, facets, {"topic": search.Filter(("alias",))}).count() == 3
    assert {r["value_key"] for r in search.facet_counts(docs, facets, 10).collect()} == {"insomnia", "pain"}


def test_match_reasons_kind_and_preview(docs):
    fields = {"topic": F.col("topics"), "body": F.array_compact(F.array("body")), "publication_year": F.array(F.col("publication_year").cast("string"))}
    of = lambda request: docs.where("body is not null").select("document_id", search.match_reasons(fields, request).alias("r")).select("document_id", "r", search.match_kind(F.col("r"), {"topic"}, search.terms(request.query)).alias("k"))
    got = {r["document_id"]: r for r in of(search.Request("the insomnia drug", {"topic": search.Filter(("Insomnia",))}, year_from=1990)).collect()}
    assert [(x["criterion"], x["field"]) for x in got[1]["r"]][:2] == [("insomnia", "topic"), ("drug", "body")] and got[1]["k"] == "tangential"
    assert ("topic:Insomnia", "topic") in [(x["criterion"], x["field"]) for x in got[1]["r"]]
    by_filter = {r["document_id"]: r["k"] for r in of(search.Request(filters={"topic": search.Filter(("INSOMNIA",))})).collect()}
    assert by_filter[1] == "direct"
    assert {r["k"] for r in of(search.Request(year_from=1990)).where("size(r) > 0").collect()} == {"tangential"} and {r["k"] for r in of(search.Request()).collect()} == {"direct"}
    spans = F.array(*[F.struct(F.lit(t).alias("text"), F.lit("s").alias("section"), F.lit("spans").alias("source_field")) for t in ("  ", "Nothing here.", "Oral drug for insomnia.", "Drug and insomnia again")])
    p = docs.limit(1).select(search.preview(spans, search.target_terms(search.Request("drug", {"topic": search.Filter(("Insomnia (INS)",))}))).alias("p"), search.preview(spans, ["drug"], 9).alias("q"), search.preview(F.slice(spans, 1, 1), ["x"]).alias("n")).first()
    assert (p["p"]["text"], p["p"]["truncated"]) == ("Oral drug for insomnia.", False) and (p["q"]["text"], p["q"]["truncated"]) == ("Oral drug", True) or p["q"]["text"] == "Oral"
    assert p["n"] is None


def test_filters_are_match_keys(docs):
    facets = index.facet_rows(docs, {"topic": F.col("topics")})
    same = [search.with_facets(docs, facets, {"topic": search.Filter(v, all_of=True)}).count() for v in (("insomnia",), ("Insomnia", "INSOMNIA (ABC)"), ("ínsómnia", "--"))]
    assert same[0] > 0 and len(set(same)) == 1
    assert search.search_trace(search.Request("a pain", {"topic": search.Filter(("!",))}, has_uncertainty=True)) == {"terms": ["pain"], "asked": {"topic": {"values": ["!"], "match": "any"}, "has_uncertainty": True}, "applied": {"has_uncertainty": True}}
    with pytest.raises(ValueError):
        search.Request(year_from=1200)


def test_publish_and_current(spark, docs, tmp_path):
    first = index.publish({"documents": docs}, str(tmp_path))
    second = index.publish({"documents": docs.limit(1)}, str(tmp_path))
    assert first != second and index.current(spark, str(tmp_path))["documents"].count() == 1


def test_windows(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 5), ("b", 3, None), (None, 4, 1)], "g string, id int, v int")
    assert rows(windows.best_per_key(df, ["g"], [F.col("v"), (-F.col("id")).alias("t")]).where("g is not null"), "g", "id") == [("a", 1), ("b", 3)]
    assert windows.best_per_key(df, ["g"], [F.col("v"), F.col("id")]).count() == 3
    assert rows(windows.first_wins(df.where("g = 'a'"), ["g"], "id"), "id") == [(1,)]
    assert [r["id"] for r in windows.round_robin(df, "g", [F.asc("id")], 4).collect()] == [4, 1, 3, 2]
    assert windows.quota_sample(df, F.col("g") == "a", "g", [F.asc("id")], 3).groupBy("direct").count().count() == 2
    picked = windows.stratified(df, [("x", F.col("v") == 5), ("y", F.col("v") == 5), ("z", F.col("v") == 9)], [F.col("id").alias("o")], "id", 3)
    assert [r["id"] for r in picked.orderBy("rank").collect()] == [1, 2, 3]


def test_aggregates(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), (None, "a")], "p string, r string")
    got = {r["label"]: (r["tp"], r["fp"], r["fn"], r["precision"]) for r in aggregates.classifier_metrics(df, "p", "r").collect()}
    assert got == {"a": (1, 1, 0, 0.5), "b": (1, 0, 1, 1.0)}
    assert rows(aggregates.coverage(df, {"p": F.col("p").isNotNull()})) == [("p", 3, 4, 75.0)]
    assert rows(aggregates.coverage(df.limit(0), {"p": F.col("p").isNotNull()})) == [("p", 0, 0, 0.0)]
    ids = spark.createDataFrame([(1, "doi", "x", "s"), (1, "doi", "x", "t"), (2, "doi", "x", "s"), (2, "doi", "y", "s"), (3, "doi", None, "s")], "id int, kind string, value string, source string")
    assert [tuple(r)[:4] for r in aggregates.project_identity(ids, "id", "kind", "value", "source").orderBy("id").collect()] == [(1, "doi", "accepted", "x"), (2, "doi", "conflict", None)]


def test_joins(spark):
    left = spark.createDataFrame([(1, "p", "x"), (2, None, "y"), (3, None, None)], "k int, a string, b string")
    right = spark.createDataFrame([("R1", "p", "z"), ("R2", "q", "y"), ("R3", "q", "y")], "id string, a string, b string")
    found = joins.priority_lookup(left, right, "k", [("a", "a", "a"), ("b", "b", "b")], "id")
    assert [tuple(r) for r in found.orderBy("k").collect()] == [(1, "a", "R1"), (2, "b", "R2"), (3, None, None)]
    assert rows(joins.multi_key_match(left, right, "k", "id", [("a", "a", "a"), ("b", "b", "b")])) == [(1, "R1", "a"), (2, "R2", "b"), (2, "R3", "b")]
    assert rows(joins.completeness(left.select("k"), left.where("k > 1").select("k"), "k")) == [("only_left", 1), ("only_right", 0)]
    assert joins.require_unique(left, "k") is left
    with pytest.raises(ValueError):
        joins.require_unique(right, "a")


def test_fuzzy_titles_against_brute_force(spark):
    import difflib

    base = ["cannabidiol for chronic pain in older adults", "nabilone in insomnia of children from the north", "dronabinol and migraine of shift workers in the west", "a scoping review of glaucoma and whole plant extract"]
    names = [v for n in base for v in (n, n[:-1], n.replace("in", "on", 1), n + " again", n.replace("a", "e", 2), "other " + n)] + ["other things"]
    right = names[::2]
    a = spark.createDataFrame([(i, n, 2000 + i % 3) for i, n in enumerate(names)] + [(99, names[0], 2099), (100, None, 2000)], "i int, t string, y int")
    b = spark.createDataFrame([(j, n, 2002) for j, n in enumerate(right)], "j int, u string, z int")
    got = {(r["i"], r["j"], r["class"]) for r in joins.fuzzy_titles(a, b, "i", "j", "t", "u", "y", "z").collect()}
    words = lambda n: {w for w in n.split() if len(w) > 2 and w not in joins.GENERIC}
    expected = set()
    for i, n in enumerate(names):
        ratio, j = max((difflib.SequenceMatcher(None, n, u).ratio(), -j) for j, u in enumerate(right))
        shared = len(words(n) & words(right[-j])) / max(1, min(len(words(n)), len(words(right[-j]))))
        for name, least, of in joins.CLASSES:
            if ratio >= least and shared >= of:
                expected.add((i, -j, name))
                break
    assert got == expected and len({c for *_, c in got}) == 2


def test_merge(spark):
    old = spark.createDataFrame([(1, "a", "open"), (2, "b", "done")], "id int, v string, status string")
    new = spark.createDataFrame([(2, "c", "open"), (3, None, "open")], "id int, v string, status string")
    once = merge.upsert(old, new, ["id"], preserve=["status"])
    assert rows(once.na.fill("-")) == [(1, "a", "open"), (2, "c", "done"), (3, "-", "open")]
    assert rows(merge.upsert(once, new, ["id"], preserve=["status"]).na.fill("-")) == rows(once.na.fill("-"))


def test_evidence(spark):
    df = spark.createDataFrame([("one two three", "x one two three y"), ("a b c d e f g h i j k", "a b c d e f g h i j z"), ("a b", "b a"), ("", "x")], "e string, s string")
    got = [r["g"] for r in df.select(evidence.grounding(F.col("e"), F.col("s")).alias("g")).collect()]
    assert [(g["exact"], g["status"]) for g in got] == [(True, "exact"), (False, "tolerant"), (False, "review"), (False, "review")]
    found = spark.createDataFrame([("We saw 24 patients and 1,200 adults in 1999 people; n = 24.",)], "t string").select(evidence.sample_sizes("t").alias("s")).first()["s"]
    assert [(s["count"], s["scope"], s["method"]) for s in found] == [(24, "patients", "figure")]
    text = "Records (n = 1,200) and twenty-four mice; a sample size of 77. We randomised arms of n = 12 and n=13. Patients were enrolled: 50, 1999 studies."
    found = spark.createDataFrame([(text,)], "t string").select(evidence.sample_sizes("t").alias("s")).first()["s"]
    assert [(s["count"], s["scope"], s["method"]) for s in found] == [(1200, "records_or_charts", "figure"), (50, "patients", "figure"), (77, "unknown", "figure"), (24, "animals", "word"), (25, "participants", "arms")]
    assert all("24" in text[s["char_start"] : s["char_end"]] or s["method"] != "figure" or str(s["count"])[:1] in text[s["char_start"] : s["char_end"]] for s in found)
    fixed = spark.createDataFrame([(["buy", "view", "odd", "buy"],)], "v array<string>").select(evidence.repair_values(F.col("v"), ["view", "purchase"], {"buy": "purchase"}).alias("r")).first()["r"]
    assert fixed["kept"] == ["purchase", "view"] and fixed["dropped"] == ["odd"]


def test_gate_and_validate(spark):
    df = spark.createDataFrame([(1, 5), (2, None)], "id int, v int")
    kept, out = index.gate(df, {"missing": F.col("v").isNull()})
    assert rows(kept, "id") == [(1,)] and out.first()["reasons"] == ["missing"]
    good, bad = index.validate(df, {"positive": F.col("v") > 0})
    assert rows(good, "id") == [(1,)] and rows(bad, "id", "violation") == [(2, "positive")]


def test_sources_and_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, v string")
    writers.write_jsonl(df, f"{tmp_path}/j")
    assert rows(readers.read_jsonl(spark, f"{tmp_path}/j", "id int, v string").na.fill("-")) == [(1, "a"), (2, "-")]
    (tmp_path / "bad.json").write_text('{"id": 1}\n\nnot json\n')
    assert readers.read_jsonl(spark, f"{tmp_path}/bad.json", "id int", strict=False).count() == 1
    (tmp_path / "Condição.csv").write_text('a,b\n1,"x\ny"\n2,"q ""z"""\n', encoding="utf-8")
    path = readers.resolve_file(str(tmp_path), "condicao.CSV")
    assert rows(readers.read_csv(spark, path, ["a", "b"])) == [("1", "x\ny", 2), ("2", 'q "z"', 3)]
    assert writers.write_frozen(df, f"{tmp_path}/f") and not writers.write_frozen(df.orderBy(F.desc("id")), f"{tmp_path}/f")
    with pytest.raises(ValueError):
        writers.write_frozen(df.limit(1), f"{tmp_path}/f")
    assert writers.write_or_clear(df, f"{tmp_path}/l") == 2 and writers.write_or_clear(df.limit(0), f"{tmp_path}/l") == 0
    assert readers.table_or_empty(spark, f"{tmp_path}/l", "id int").count() == 0
    assert writers.manifest({"a": df}, "r").first()["rows"] == 2
    (tmp_path / "x.xml").write_text('<S><PubmedArticle><MedlineCitation><PMID>7</PMID><Article><ArticleTitle>T</ArticleTitle></Article></MedlineCitation><PubmedData><ArticleIdList><ArticleId IdType="doi">10.1/OWN</ArticleId></ArticleIdList><ReferenceList><Reference><ArticleIdList><ArticleId IdType="pmc">PMC9</ArticleId></ArticleIdList></Reference></ReferenceList></PubmedData></PubmedArticle></S>')
    article = readers.read_articles(spark, f"{tmp_path}/x.xml").first()
    assert (article["pmid"], article["doi"], article["pmcid"], article["title"]) == ("7", "10.1/own", None, "T")
    (tmp_path / "p.html").write_text("<!DOCTYPE html><p>hello</p>")
    payload = readers.read_payloads(spark, f"{tmp_path}/p.html").first()
    assert (payload["format"], payload["text"]) == ("html", "hello")
