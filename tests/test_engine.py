import pytest
from pyspark.sql import functions as F

from litscout import __main__ as cli
from litscout import engine
from litscout.operators.search import Filter, Request


@pytest.fixture
def folder(spark, tmp_path):
    rows = [("a", "Oral drug for pain", 2020, "en"), ("b", "Pain in children", 2021, "pt"), ("c", None, None, None)]
    df = spark.createDataFrame(rows, "document_id string, title string, publication_year int, lang string")
    engine.build(df, str(tmp_path / "index"), ["title"], {"lang": F.when(F.col("lang").isNotNull(), F.array("lang"))})
    return str(tmp_path / "index")


def test_engine(spark, folder):
    held = engine.Engine(spark, folder)
    page, envelope = held.search(Request("pain", limit=1))
    assert [r["document_id"] for r in page.collect()] == ["b"] and envelope["total"] == 2
    following, last = held.search(Request("pain", limit=1, cursor=envelope["next"]))
    assert [r["document_id"] for r in following.collect()] == ["a"] and last["next"] is None
    assert {r["value_key"]: r["documents"] for r in held.facets(Request("pain")).collect()} == {"en": 1, "pt": 1}
    assert held.search(Request(filters={"lang": Filter(("en",))}))[1]["total"] == 1
    assert held.get("a")["title"] == "Oral drug for pain"
    with pytest.raises(KeyError):
        held.get("z")
    assert held.capabilities()["families"] == {"lang": 2}
    assert [tuple(r) for r in held.coverage(["title"]).collect()] == [("title", 2, 3, 66.67)]


def test_results_say_why(spark, folder):
    held = engine.Engine(spark, folder)
    fields = {"title": F.array("title"), "lang": F.array("lang")}
    spans = F.array(F.struct(F.col("title").alias("text"), F.lit("title").alias("section"), F.lit("title").alias("source_field")))
    page, _ = held.results(Request("pain", {"lang": Filter(("EN",))}), fields, {"title"}, spans)
    row = page.first()
    assert row["match"] == "direct" and row["preview"]["text"] == "Oral drug for pain" and [(r["criterion"], r["field"]) for r in row["reasons"]] == [("pain", "title"), ("lang:EN", "lang")]


def test_a_document_may_not_occur_twice(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("a", 1)], "document_id string, publication_year int")
    with pytest.raises(ValueError):
        engine.build(df, str(tmp_path / "i"), [], {})


def test_command_line(capsys):
    cli.main(["queries"])
    assert "search_terms_facets" in capsys.readouterr().out
