from litscout.plans import catalog


def test_identifiers_are_counted_exactly(spark, tables):
    rows = [(str(i % 20_000 + 10_000), None) for i in range(30_000)] + [(None, "10.1000/a"), (None, "10.1000/A"), ("x", None)]
    sf = tables(pubmed_candidate=(rows, "pmid string, doi string"))
    got = {(r["kind"], r["rule"], r["given"]): (r["n"], r["about_distinct"]) for r in catalog.QUERIES["identifiers_normalized"](spark, sf).collect()}
    assert got == {
        ("pmid", "trim_prefix_and_slash.v1", True): (30_000, 20_000), ("pmid", None, False): (2, 0), ("pmid", None, True): (1, 0),
        ("doi", None, False): (30_001, 0), ("doi", "lowercase_and_trim_punctuation.v1", True): (2, 1),
    }
