import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from litscout.llm import language

SENTENCES = {
    "en": ["The participants were given a small dose every morning and the pain was lower.", "Of all the people who came to the visit most of them reported no change in sleep."],
    "pt": ["Os participantes receberam uma pequena dose todas as manhãs e a dor foi menor.", "Não houve diferença entre os grupos depois de algumas semanas de acompanhamento."],
    "es": ["Los participantes recibieron una pequeña dosis cada mañana y el dolor fue menor.", "No hubo diferencias entre los grupos después de unas semanas de seguimiento."],
    "fr": ["Les participants ont reçu une petite dose chaque matin et la douleur a diminué.", "Aucune différence n'a été trouvée entre les groupes après quelques semaines."],
    "de": ["Die Teilnehmenden erhielten jeden Morgen eine kleine Dosis und der Schmerz sank.", "Zwischen den Gruppen wurde nach einigen Wochen kein Unterschied gefunden."],
}
SCHEMA = "document_id string, language string, abstract string, title_pt string, key int, a int, lang int"


@pytest.fixture(scope="module")
def network():
    rows = [(" ".join(s), lang) for lang, s in SENTENCES.items() for _ in range(6)]
    return language.fit(pd.DataFrame(rows, columns=["text", "label"]))


def test_gradients_match_differences():
    net, x, y = language.Network(seed=1), np.random.default_rng(0).integers(0, 256, (3, language.LENGTH)).astype(np.uint8), np.array([0, 1, 2])
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    drop = np.ones((3, language.FILTERS * len(language.WIDTHS)))
    loss = lambda: -np.log(net.forward(x)[np.arange(3), y]).mean()
    grad = net.gradients(x, y, drop)
    for name in ("out", "f3", "b3", "embed"):
        at = np.unravel_index(np.abs(grad[name]).argmax(), grad[name].shape)
        old = net.p[name][at]
        net.p[name][at] = old + 1e-5
        up = loss()
        net.p[name][at] = old - 1e-5
        down = loss()
        net.p[name][at] = old
        assert grad[name][at] == pytest.approx((up - down) / 2e-5, rel=2e-2, abs=1e-5)


def test_parts_of_a_mixed_text_in_capitals_without_accents(network):
    text = SENTENCES["pt"][0] + "\n" + language.plain(SENTENCES["fr"][0]).upper() + " " + SENTENCES["fr"][1]
    (parts,) = language._parts(network, [text])
    assert [p["lang"] for p in parts] == ["pt", "fr"] and all(0.5 < p["confidence"] <= 1 for p in parts)
    assert text[parts[1]["char_start"] :].startswith("LES")


def test_nothing_to_say(network):
    assert language._parts(network, [None, "", "  \n", "12 (3) ..."]) == [None, [], [], []]
    assert language._parts(None, ["some text"]) == [[]]
    long = " ".join(SENTENCES["de"] * 500)
    assert [p["lang"] for p in language._parts(network, [long])[0]] == ["de"]


def test_labels(spark):
    given = ["Português", "pt-BR", "ENG", "fre", None, "", "und", "mul", "n/a", "pt;en", "es_MX", "Français"]
    df = spark.createDataFrame([(i, g) for i, g in enumerate(given)], "i int, g string")
    got = [r["l"] for r in df.orderBy("i").select(language.named_languages(F.col("g")).alias("l")).collect()]
    assert got == [["pt"], ["pt"], ["en"], ["fr"], [], [], [], [], [], ["en", "pt"], ["es"], ["fr"]]


def test_found(spark, tables):
    docs = [(i, " ".join(s), lang, 1) for i, (lang, s) in enumerate(list(SENTENCES.items()) * 6)]
    pt, en, fr = SENTENCES["pt"][0], SENTENCES["en"][0], SENTENCES["fr"][1]
    pubs = [("a", "por", pt, pt, 0, 0, 0), ("b", "en", pt, en, 0, 0, 0), ("c", "pt;en", pt + " " + en, None, 0, 0, 0), ("d", None, None, "", 0, 0, 0), ("e", "?", fr, pt, 0, 0, 0), ("e", "?", fr, pt, 0, 0, 0)]
    sf = tables(documents=(docs, "doc_id bigint, text string, lang string, label int"), publication=(pubs, SCHEMA))
    got = {tuple(r) for r in language.found(spark, sf).collect()}
    assert got == {("b", "abstract", "pt"), ("b", "title_pt", "en"), ("c", "abstract", "pt"), ("c", "abstract", "en"), ("e", "abstract", "fr")}
    assert language.found(spark, sf).count() == len(got)


def test_empty_tables(spark, tables):
    sf = tables(documents=([], "doc_id bigint, text string, lang string"), publication=([], SCHEMA))
    assert language.found(spark, sf).count() == 0 and language.segments(spark, sf).count() == 0
