"""Problems 7, 8 and 9 on small tables."""

import random

from pyspark.sql import functions as F

from litscout.llm import leakage, mixture, residue

ITEM = "Night recordings in Dalima captured 453 episodes of glaucoma, 12 of them within 22 hours of a capsule. Tissue from 16 donors in Zutara bound the drug about 26 times harder."
OTHER = "Night recordings in Pevene captured 656 episodes of glaucoma, 11 of them within 50 hours of a capsule. Two readers in Kemora scored 99 diaries and disagreed on 7, chiefly when a dose had been skipped."
PLAIN = "The committee approved the plan before the first person was enrolled in the long study of many people. "


def test_leaks(spark, tables):
    exact = PLAIN + ITEM.upper().replace(" ", "\n", 3) + PLAIN
    exchanged = PLAIN + "Night recordings in Dalima such 453 episodes of glaucoma, 12 rather them within 22 hours mostly a capsule." + PLAIN
    similar = PLAIN + "Night recordings in Ralora captured 111 episodes of glaucoma, 9 of them within 3 hours of a capsule." + PLAIN
    short = PLAIN + "Dalima captured 453 episodes of glaucoma, 12" + PLAIN
    rows = [(1, exact, 0), (2, exchanged, 0), (3, similar, 0), (4, short, 0), (5, None, 0), (6, "", 0), (7, PLAIN * 3000 + ITEM, 0), (1, exact, 0), (None, exact, 0)]
    sf = tables(documents=(rows, "doc_id bigint, text string, item_id int"), benchmark=([(1, ITEM), (2, OTHER), (3, None), (4, "")], "item_id bigint, text string"))
    assert sorted(tuple(r) for r in leakage.found(spark, sf).collect()) == [(1, 1), (2, 1), (7, 1)]


LONG = "Two readers in Soveneth scored 761 diaries on liver safety and disagreed on 9, chiefly when the plant extract had simply been skipped by nearly all of the people who were asked to take it twice each day."


def test_short_runs_without_figures_are_leaks(spark, tables):
    """10, 12, 15 and 19 words of the item, word for word, none of them a figure or a name."""
    words = LONG.split()
    at = words.index("chiefly")
    texts = {n: f"{PLAIN}{' '.join(words[at:at + n])}. {PLAIN}" for n in (9, 10, 12, 15, 19)}
    sf = tables(documents=([(n, t) for n, t in texts.items()], "doc_id bigint, text string"), benchmark=([(1, LONG), (2, OTHER)], "item_id bigint, text string"))
    assert sorted(r["doc_id"] for r in leakage.found(spark, sf).collect()) == [10, 12, 15, 19]


def test_a_run_belongs_to_the_item_that_has_more_of_it(spark, tables):
    a = "Pharmacists in Balorun rejected 28 of every 819 scripts where blood pressure was missing or insomnia stood twice on the form of that day."
    b = "Pharmacists in Raloria rejected 19 of every 316 leaflets where blood pressure was missing or insomnia stood twice on the desk."
    sf = tables(documents=([(1, PLAIN + a + PLAIN), (2, PLAIN + b)], "doc_id bigint, text string"), benchmark=([(1, a), (2, b)], "item_id bigint, text string"))
    assert sorted(tuple(r) for r in leakage.found(spark, sf).collect()) == [(1, 1), (2, 2)]


def test_several_indexes_give_the_same(spark, tables, monkeypatch):
    sf = tables(documents=([(1, PLAIN + ITEM), (2, OTHER + LONG)], "doc_id bigint, text string"), benchmark=([(1, ITEM), (2, OTHER), (3, LONG)], "item_id bigint, text string"))
    once = sorted(tuple(r) for r in leakage.found(spark, sf).collect())
    monkeypatch.setattr(leakage, "MAX_ITEMS", 1)
    assert sorted(tuple(r) for r in leakage.found(spark, sf).collect()) == once and len(once) >= 3


def test_no_items(spark, tables):
    sf = tables(documents=([(1, ITEM)], "doc_id bigint, text string"), benchmark=([], "item_id bigint, text string"))
    assert leakage.found(spark, sf).count() == 0


def test_search_equals_brute_force():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(30)]
    items = [(i, " ".join(rng.choice(words) for _ in range(25))) for i in range(80)]
    index = leakage.Index(items)
    for _ in range(100):
        passage = [rng.choice(words) for _ in range(leakage.WINDOW)]
        pairs = set(zip(passage, passage[1:]))
        score = {}
        for w in pairs:
            for at, c in zip(*index.terms.get(w, ([], []))[:2]):
                score[at] = score.get(at, 0) + c
        assert sorted(index.search(passage)) == sorted(at for at, s in score.items() if s >= index.threshold)


def test_every_leaked_run_reaches_the_threshold():
    index = leakage.Index([(1, ITEM), (2, OTHER)])
    for at, item in enumerate(index.words):
        for k in range(len(item) - leakage.MIN_WORDS + 1):
            run = [w if j % (leakage.BETWEEN + 1) != leakage.BETWEEN or w.isdigit() or w in index.names else "zzz" for j, w in enumerate(item[k : k + leakage.MIN_WORDS])]
            assert at in index.search(["filler"] * 11 + run + ["filler"] * 11)


WEIGHT = "source string, target_share double, max_repeats int"


def test_mixture(spark):
    rng = random.Random(1)
    docs = [(i, s, rng.randint(50, 500)) for i, s in enumerate(["big"] * 3000 + ["small"] * 40 + ["alien"] * 10)] + [(9999, "big", 0)]
    df = spark.createDataFrame(docs, "doc_id bigint, source string, tokens bigint")
    used, planned = mixture.mix(df, {"big": (0.6, 2), "small": (0.3, 4), "absent": (0.1, 9)})
    rows = used.collect()
    size = {s: sum(r["tokens"] * r["copies"] for r in rows if r["source"] == s) for s in ("big", "small")}
    total = sum(size.values())
    assert abs(size["big"] / total - 2 / 3) < 0.003 and {r["source"] for r in rows} == {"big", "small"}
    assert all(r["copies"] == 4 for r in rows if r["source"] == "small") and max(r["copies"] for r in rows if r["source"] == "big") <= 2
    assert len(rows) == len({r["doc_id"] for r in rows})
    again, _ = mixture.mix(df.repartition(7), {"big": (0.6, 2), "small": (0.3, 4), "absent": (0.1, 9)})
    assert {tuple(r) for r in again.collect()} == {tuple(r) for r in rows}
    half, _ = mixture.mix(df, {"big": (0.6, 2), "small": (0.3, 4)}, total=total / 2)
    assert abs(half.agg(F.sum(F.col("tokens") * F.col("copies"))).first()[0] / (total / 2) - 1) < 0.01


def test_mixture_of_tables(spark, tables):
    rows = [(1, "a", "some words here", 1), (1, "a", "some words here", 1), (2, "a", None, 1), (3, None, "text", 1), (4, "b", "", 1), (5, "b", "<|endoftext|> is plain text", 1)]
    sf = tables(documents=(rows, "doc_id bigint, source string, text string, tokens int"), source_weight=([("a", 0.5, 1), ("b", 0.4, 3), ("c", 0.1, 2), ("d", None, 1)], WEIGHT))
    assert {r["doc_id"] for r in mixture.mixture(spark, sf).collect()} <= {1, 5}
    shares = {r["source"]: r for r in mixture.shares(spark, sf).collect()}
    assert set(shares) == {"a", "b", "c"} and shares["c"]["used_tokens"] == 0


def test_empty_mixture(spark, tables):
    sf = tables(documents=([], "doc_id bigint, source string, text string"), source_weight=([], WEIGHT))
    assert mixture.mixture(spark, sf).count() == 0 and mixture.shares(spark, sf).count() == 0


def test_residue(spark, tables):
    texts = [
        "Please enable JavaScript in your browser to view this article.", f"{PLAIN}\n\n404 - page not found. It has been moved.\n{PLAIN}", f"Study of {{{{title}}}} in adults. {PLAIN}", f"From undefined: {PLAIN}",
        "blah blah blah blah blah blah", "INSERT TITLE HERE\nAuthor name(s)", f"{PLAIN * 2000}\nYour session has expired. Please sign in again.",
    ]
    fine = [
        PLAIN, "The questionnaire ran in the browser and required JavaScript, so adults without a computer used paper forms.", "Let {x} denote the dose and {{x, y}} the set of 5 readings.",
        "Scores below [11] were set to missing; see <appendix> for the $174 vouchers and the 30% rule.", "Of 404 records found, 85 were read in full.", "Children were not found at home on 5 visits, and the page on consent was signed later.", "", None,
    ]
    rows = [(i, t, 0) for i, t in enumerate(texts + fine)] + [(0, texts[0], 0)]
    sf = tables(documents=(rows, "doc_id bigint, text string, template int"))
    assert sorted(r["doc_id"] for r in residue.found(spark, sf).collect()) == list(range(len(texts)))
    assert sorted(r["doc_id"] for r in residue.kept(spark, sf).collect()) == list(range(len(texts), len(rows) - 1))
    assert {r["kind"] for r in residue.templates(spark, sf).collect()} == {"notice", "error", "filler", "form"}


def test_no_residue_in_nothing(spark, tables):
    sf = tables(documents=([], "doc_id bigint, text string"))
    assert residue.found(spark, sf).count() == 0


def test_several_trees_give_the_same(spark, monkeypatch):
    df = spark.createDataFrame([(1, "INSERT TITLE HERE"), (2, "Your text goes here"), (3, PLAIN), (4, "Internal server error. Sorry.")], "doc_id int, text string")
    monkeypatch.setattr(residue, "MOST", 1)
    assert sorted(r["doc_id"] for r in residue.detect(df, "doc_id").collect()) == [1, 2, 4]


def test_residue_in_words_of_no_list(tables):
    """Phrases that neither the cues nor the labelled phrases have."""
    ordinary = [(f"{w} {x} were measured in the {y} group after <*> weeks of treatment .".split(), "ordinary", (1.0, 0.1, 0.1, 1.0), ()) for w in ("doses", "scores", "levels", "diaries") for x in ("of pain", "of sleep", "in plasma") for y in ("first", "second", "other")]
    model = residue.fit(ordinary + [(p.split(" "), kind, None, ()) for kind, phrases in residue.PHRASES.items() for p in phrases])
    kind = lambda t: residue.KINDS[model.text(t.split()).argmax()]
    held_out = ["this site requires scripts to run", "esta página requiere javascript", "seite nicht verfügbar", "enter your abstract below", "content not available in your region", "an error has occurred on the server"]
    assert all(residue.label(t)[0] is None for t in held_out)
    assert sum(kind(t) != "ordinary" for t in held_out) >= 5
    assert kind("diaries of pain were measured in the third group after <*> weeks") == "ordinary"


def test_what_mining_finds_decides(spark):
    """The same words are residue as a line of their own in many sources, and not inside texts of one."""
    model = residue.Classifier(index={"request": 0, "help": 1}, words=residue.np.array([[0, 0.5, 0, 0, 0]] * 3, "float32"))
    model.mined[1:, 1] = 1.0
    rows = [("request help now", "request help now", 10, 10, 10, 2), ("request help again", "request help again", 10, 0, 0, 1)]
    mined = spark.createDataFrame(rows, "template string, merged string, n bigint, alone bigint, lead bigint, sources int")
    assert [r["template"] for r in residue.classify(mined, model).collect()] == ["request help now"]


def test_filler_of_unknown_words(spark):
    rng = random.Random(1)
    made = [" ".join(rng.choice("larem ipsar dolan vulna noctis tempra sedam elitra".split()) for _ in range(60)) + "." for _ in range(3)]
    plain = "The team of {} measured the sleep of {} people with care, and the others kept to their usual habits in that year."
    rows = [(i, plain.format(f"Site{i}", i)) for i in range(30)] + [(100 + i, f"{plain.format('Sora', 7)}\n{m}") for i, m in enumerate(made)] + [(200, plain.format("Sora", 8) + "\nLarem vulna dolan sedam noctis.")]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    assert sorted(r["doc_id"] for r in residue.detect(df, "doc_id").collect()) == [100, 101, 102, 200]


def test_cues_are_not_absorbed_by_wildcards():
    tree = residue.PrefixTree()
    for n in range(5):
        tree.add(["the", "trial", "enrolled", residue.ANY, "participants", "over", "two", "years", "in", f"site{n}"])
    own = tree.add("the trial enrolled xx participants over two years in site1".split())
    assert "xx" in own[0]


def test_crowded_leaves_are_split():
    tree = residue.PrefixTree()
    for a in range(40):
        for b in range(10):
            tree.add(["in", "the", f"a{a}", f"b{b}", f"c{a * b}", "d"])
    assert max(map(len, tree.leaves.values())) <= residue.CROWD and sum(e[1] for e in tree.entries()) == 400
