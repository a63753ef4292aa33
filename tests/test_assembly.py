"""Assembled records, samples and reports, with their errors."""

import pytest
from pyspark.sql import functions as F

from litscout.functions import ids
from litscout.operators import aggregates, assembly, evidence, joins, windows
from litscout.sources import writers


def test_assertions_raise(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    twice = a.unionByName(a.limit(1))
    assert joins.require_complete(a, a.select("k"), "k").count() == 2
    for call in (
        lambda: joins.require_complete(a, a.where("k = 1").select("k"), "k"), lambda: joins.require_complete(a, twice.select("k"), "k"), lambda: assembly.retry_set(a, spark.createDataFrame([(3,)], "k int"), "k"),
        lambda: assembly.in_order(a, spark.createDataFrame([(1, 1), (1, 2)], "k int, p int"), "k", "p"), lambda: assembly.in_order(a, spark.createDataFrame([(5, 1)], "k int, p int"), "k", "p"),
        lambda: assembly.with_decisions(a, spark.createDataFrame([(1, "z", "ok")], "k int, v string, d string"), "k", ["v"], "d"),
        lambda: assembly.require_same(assembly.snapshot({"a": a}), assembly.snapshot({"a": twice})), lambda: windows.holdout(a, "v", "k", [F.asc("k")], {"x": 2}),
        lambda: aggregates.require_within(aggregates.batch_sizes(a, "k", F.repeat("v", 100), 3)),
    ):
        with pytest.raises(ValueError):
            call()
    assembly.require_same(assembly.snapshot({"a": a}), assembly.snapshot({"a": a}))


def test_detail_of_nothing(spark):
    parents = spark.createDataFrame([(1,), (2,)], "k int")
    child = spark.createDataFrame([(1, 5, "b"), (1, 4, "a"), (9, 1, "z")], "k int, n int, t string")
    got = {r["k"]: ([(c["n"], c["t"]) for c in r["a"]], list(r["b"])) for r in assembly.detail(parents, "k", {"a": (child, ["n"]), "b": (child.limit(0), ["n"])}).collect()}
    assert got == {1: ([(4, "a"), (5, "b")], []), 2: ([], [])}


def test_overlay_takes_the_later_map(spark):
    df = spark.createDataFrame([(" ", {"a": "1", "b": "2"}, {"a": "3"}), ("own", None, None)], "a string, p map<string,string>, q map<string,string>")
    assert [r["a"] for r in df.select(*assembly.overlay({"a": F.col("a")}, F.col("p"), F.col("q")).values()).collect()] == ["3", "own"]


def test_pages_are_clamped():
    assert [windows.page_of(45, p, 20) for p in (0, 1, 3, 9)] == [(1, 0), (1, 0), (3, 40), (3, 40)] and windows.page_of(0, 4, 20) == (1, 0)


def test_label_evidence(spark):
    text = "We studied people with chronic pain for many weeks. Multiple sclerosis was rare in the whole sample. Chronic pain came again later on."
    df = spark.createDataFrame([(text, ["chronic pain (CP)", "multiple sclerosis"]), (None, ["x"]), (text, None)], "t string, l array<string>")
    got = df.select(evidence.locate_labels(F.col("t"), F.col("l")).alias("e")).collect()
    assert [(e["label"], text[e["char_start"] : e["char_end"]].strip()) for e in got[0]["e"]] == [("chronic pain (CP)", text.split(". ")[0] + "."), ("multiple sclerosis", text.split(". ")[1] + ".")]
    assert got[1]["e"] == [] and got[2]["e"] == []
    assert evidence.label_forms("type two diabetes (T2D)") == ["type two diabetes (T2D)", "type two diabetes", "T2D"]


def test_address_and_article_identifiers(spark):
    page = "<article-meta><article-id pub-id-type='doi'>10.1/own</article-id></article-meta><ref><article-id pub-id-type='doi'>10.1/cited</article-id></ref><meta name='citation_doi' content='10.1/meta'>"
    r = spark.createDataFrame([("https://pmc.ncbi.nlm.nih.gov/articles/PMC12/", page)], "u string, p string").select(ids.from_address("pmcid", F.col("u")).alias("a"), ids.from_address("pmid", F.col("u")).alias("b"), ids.from_article("doi", F.col("p")).alias("d")).first()
    assert (r["a"], r["b"]) == ("PMC12", None) and [(v["value"], v["method"]) for v in r["d"]] == [("10.1/own", "nxml_article_id"), ("10.1/meta", "html_citation_meta")]


def test_materialise_checks_the_hash(spark, tmp_path):
    import hashlib

    source, target = tmp_path / "a.bin", tmp_path / "b.bin"
    source.write_bytes(b"held")
    right = hashlib.sha256(b"held").hexdigest()
    assert writers.materialise(spark, str(source), str(target), right) and not writers.materialise(spark, str(source), str(target), right)
    assert target.read_bytes() == b"held"
    with pytest.raises(ValueError):
        writers.materialise(spark, str(source), str(tmp_path / "c.bin"), "0" * 64)
