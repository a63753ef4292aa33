"""Problem 9: template residue, filler, error pages and script notices inside documents.

Method: message templates are mined with a fixed-depth prefix tree (token count, then the first DEPTH tokens, deeper only in
crowded leaves, then the most similar template of that leaf, whose differing tokens become wildcards). A classifier of
templates, fitted here, weighs their words and what mining found out about them: the share of fixed words, how often they
stand on a line of their own, come first, and occur under several sources. Each template is classified once, and its verdict
goes to all its sentences. Slots left unfilled inside ordinary sentences are found by their own patterns, filler by its
vocabulary: runs of words that hardly repeat anything but each other and that the corpus has nowhere else.

The classifier is a softmax regression in numpy. Its labels are weak: the cue lists below say which templates of a bounded
sample (SAMPLE documents, TRAIN templates of each kind) are residue; each is learned with and without the words of its cue, so that the other
words carry the verdict too, beside a few labelled phrases. The corpus is read once with it: a task grows a tree over its
sentences, at most MOST templates at a time, and gives on only what can still be residue, whatever mining finds out, so that
ordinary sentences are not shuffled; the trees' leaves are merged, and what is left is classified.

Defined results: a null text is no case, nor is an empty one (it holds nothing at all, not residue). A document is
listed once, however often its row is repeated; null keys are left out. Texts are read whole, of any length.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litscout.session import cut, spread, table

ANY = "<*>"
DEPTH = 2  #: leading tokens that choose the leaf
CROWD = 16  #: templates of a leaf from which it is split by its next token
SIMILAR = 0.7  #: share of equal tokens from which a sentence belongs to a template
MOST = 50_000  #: templates that a task keeps; then it grows a new tree, which costs time and changes no verdict on a sentence
SAMPLE, TRAIN = 20_000, 4_000  #: documents and templates of each kind for fitting, at most
HEAVIEST = 8  #: times that a rare kind's template weighs as much as an ordinary one, at most
LONGEST = 60  #: tokens of a template for fitting
GROUP = 5_000  #: candidates of a leaf that are merged in one task; larger leaves are split by further tokens
KINDS = ("ordinary", "error", "form", "notice", "filler")
MINED = ("fixed", "alone", "lead", "sources")  #: what mining says of a template, each from 0 to 1
WINDOW, RICH = 40, 0.5  #: tokens of a run, and the share of different ones up to which it may be filler
FEW = 100_000  #: words that are broadcast; more are joined by shuffle
IDLE = 0.5  #: share of a word's documents in which it stands in such a run, from which it is a filler's word

# The cues by which templates are labelled for fitting, in English, Portuguese, Spanish, French and German.
STATUS = (
    "page not found", "page cannot be found", "página não encontrada", "página no encontrada", "page introuvable", "seite nicht gefunden",
    "internal server error", "bad gateway", "gateway timeout", "service unavailable", "service temporarily unavailable", "too many requests",
    "content is restricted", "access denied", "acceso denegado", "acesso negado", "accès refusé", "zugriff verweigert", "permission to view",
    "session has expired", "sesión ha caducado", "sessão expirou", "session a expiré", "sitzung ist abgelaufen", "sign in again",
    "traceback:", "error al cargar", "não foi possível carregar", "impossible de charger", "konnte nicht geladen werden",
    "try again in", "try again later", "tente novamente", "vuelva a intentarlo", "veuillez réessayer", "versuchen sie es", "upstream host",
    "no longer available at this address", "não está mais disponível neste endereço", "prüfen sie die adresse", "has been moved or removed",
)
MACHINE = ("javascript", "script", "scripts", "scripting", "cookie", "cookies", "browser", "navegador", "navigateur", "robot", "human", "captcha")
ADDRESS = (
    "please", "your", "you", "turn on", "turn them on", "enable", "switched on", "switch scripting on", "tick the box", "checking that", "ative", "habilite", "seu navegador",
    "su navegador", "actívelos", "active", "veuillez", "activez", "votre navigateur", "bitte", "aktivieren sie", "ihr browser", "confirm",
)
FORM = (
    "title here", "abstract here", "text here", "text goes here", "in this box", "keyword <*> keyword", "author name(s)", "todo:", "tbd:", "fixme", "xx participants", "aged xx",
    "escreva aqui", "digite aqui", "insira aqui", "ponga aquí", "escriba aquí", "título do artigo em inglês", "título del artículo en", "écrivez ici", "saisissez ici", "hier eingeben", "hier einfügen",
)
FILLER = ("lorem ipsum", "dolor sit amet", "asdf", "qwerty", "blah blah", "sample text")
#: Slots left unfilled, and the empty values that programs print into them. {x}, [11], <appendix>, $174 and 30% are none.
NAME = r"[A-Za-z][A-Za-z_.]*"
SLOTS = (
    rf"\{{\{{\s*{NAME}\s*\}}\}}|\{{%\s*{NAME}\s*%\}}|[$#]\{{\s*{NAME}\s*\}}|@@{NAME}@@|<%=?\s*{NAME}\s*%>|\[\[{NAME}\]\]"
    rf"|%[A-Z][A-Z_.]+%|\b__[A-Za-z][A-Za-z_.]*?__|\[[A-Z][A-Z_.]{{2,}}\]|\[[a-z]+[_.][a-z_.]+\]|%[a-z]+[_.][a-z_.]+%"
)
EMPTY_VALUES = r"\[object Object\]|#REF!|#N/A|#VALUE!|#NAME\?|\?{4,}|(?<![\w-])(?:undefined|null|NaN|NULL|NoneType)(?![\w-])"

# Labelled phrases for fitting, beside the templates of the corpus.
PHRASES = {
    "error": (
        "the page could not be loaded", "this document is currently not available", "we could not find the article", "an unexpected error occurred", "the request failed", "the connection timed out",
        "this content is not available for your account", "the file was not found on this server", "service is down for maintenance", "the server is not responding", "database connection failed",
        "a página não pôde ser carregada", "o artigo não está disponível", "ocorreu um erro inesperado", "serviço indisponível", "la página no está disponible", "se ha producido un error inesperado",
        "servicio no disponible", "el artículo no se pudo cargar", "la page n'est pas disponible", "une erreur inattendue s'est produite", "service indisponible", "le document n'a pas pu être chargé",
        "die seite ist nicht erreichbar", "ein unerwarteter fehler ist aufgetreten", "der dienst ist nicht verfügbar", "das dokument konnte nicht gefunden werden",
    ),
    "form": (
        "enter your text here", "your title goes here", "type your abstract in this field", "add a short description here", "paste your text below", "replace this text with your abstract", "write your summary below",
        "insira o título aqui", "cole aqui o texto", "introduzca aquí el texto", "añada aquí una descripción", "insérez ici votre titre", "collez ici votre texte", "titel hier eintragen", "fügen sie hier ihren text ein",
    ),
    "notice": (
        "javascript is disabled in your browser", "javascript is required to view this site", "this site works best with scripts enabled", "please allow cookies to continue", "verify that you are a human",
        "complete the security check to continue", "your browser is not supported", "este site requer javascript", "seu navegador não é compatível", "verifique que você não é um robô", "permita cookies para continuar",
        "este sitio requiere javascript", "su navegador no es compatible", "verifique que no es un robot", "ce site nécessite javascript", "votre navigateur n'est pas compatible", "vérifiez que vous n'êtes pas un robot",
        "diese seite benötigt javascript", "ihr browser wird nicht unterstützt", "bestätigen sie dass sie kein roboter sind",
    ),
}

_BREAK = re.compile(r"(?<=[.!?…])\s+|\s*\n\s*")
_NUMBER = re.compile(r"\S*\d\S*")
_WORD = re.compile(r"[^\W\d_]+")
_SLOT = re.compile(f"{SLOTS}|{EMPTY_VALUES}")
_HYPHEN = re.compile(r"(?<=\w)[-‐­]\s*\n\s*(?=\w)")
_MAY_BE_SLOT = re.compile(r"[{\[<%$#@]|__|\?{4}|undefined|null|NaN|NULL|NoneType")  # what every slot and empty value has
_AGAIN = re.compile(r"(?<!\S)((?!<\*>)\S+(?: (?!<\*>)\S+)?)(?: \1){3,}(?!\S)")  # the same one or two words four times on end


def _pattern(words: tuple[str, ...]) -> re.Pattern:
    return re.compile("|".join(rf"(?<!\w){re.escape(w)}" + (r"(?!\w)" if w[-1].isalnum() else "") for w in words))


#: Words of the cues, which no wildcard may take: "XX participants" is not a form of "40 participants".
CUES = frozenset(w for words in (STATUS, MACHINE, ADDRESS, FORM, FILLER) for cue in words for w in _WORD.findall(cue) if len(w) > 3 or w == "xx")
_SIGNS = CUES | {"error", "erro", "erreur", "fehler", "found", "gateway", "permission", "forbidden", "unavailable"}  # one of them is in all that label() knows

_STATUS, _MACHINE, _ADDRESS, _FORM, _FILLER = map(_pattern, (STATUS, MACHINE, ADDRESS, FORM, FILLER))
_CODE = re.compile(r"^(?:http )?<\*>:? .*(?:error|erro|not found|gateway|permission|forbidden|unavailable)|^(?:erro|error|erreur|fehler) <\*>:")


def repeats(tokens: list[str]) -> bool:
    """Whether the same one or two words come four times on end: filler in any language."""
    return 2 * len(set(tokens)) <= len(tokens) + 1 and _AGAIN.search(" ".join(tokens)) is not None


def _is_cue(token: str) -> bool:
    return token.strip(".,:;!?()") in CUES


def label(template: str) -> tuple[str | None, tuple[re.Pattern, ...]]:
    """The kind a template seems to be by its cues, and those cues; None without. Only fitting and repetitions rely on it."""
    tokens = template.split(" ")
    if repeats(tokens):
        return "filler", (_AGAIN,)
    if _SIGNS.isdisjoint(_WORD.findall(template)):
        return None, ()
    for kind, cues in (("filler", (_FILLER,)), ("form", (_FORM,)), ("error", (_STATUS,)), ("error", (_CODE,)), ("notice", (_MACHINE, _ADDRESS))):
        if all(c.search(template) for c in cues):
            return kind, cues
    return None, ()


def lines(text: str) -> Iterator[tuple[list[str], bool, bool]]:
    """Lower-case tokens of each sentence, tokens with a digit as wildcards; whether it is a line of its own, and the first."""
    first = True
    for line in _HYPHEN.sub("", text).splitlines():
        parts = [p for p in _BREAK.split(line) if p]
        for part in parts:
            if tokens := _NUMBER.sub(ANY, part.lower()).split():
                yield tokens, len(parts) == 1, first
                first = False


class PrefixTree:
    """Templates by token count and first tokens. A template is [tokens, count, cached verdict, places of wildcards]."""

    def __init__(self) -> None:
        self.leaves: dict[tuple, list[list]] = {}
        self.crowded: set[tuple] = set()
        self.exact: dict[str, list] = {}

    def leaf(self, tokens: list[str]) -> tuple:
        depth = DEPTH
        while (at := (len(tokens), *tokens[:depth])) in self.crowded:
            depth += 1
        return at

    def match(self, tokens: list[str]) -> list | None:
        """The most similar template of the leaf, if similar enough. A wildcard of it equals anything but a word of a cue."""
        best, most = None, SIMILAR * len(tokens)
        for entry in self.leaves.get(self.leaf(tokens), ()):
            same = sum(map(eq, entry[0], tokens))
            if same + len(entry[3]) >= most:
                free = [tokens[k] for k in entry[3]]
                same += len(free) - free.count(ANY)
                if same >= most and not any(map(_is_cue, free)):
                    best, most = entry, same
                    if same == len(tokens):
                        break
        return best

    def add(self, tokens: list[str], count: int = 1) -> list:
        """The template of a sentence, which it may widen. A widened template has no verdict until it gets a new one."""
        text = " ".join(tokens)
        entry = self.exact.get(text)
        if entry is None:
            entry = self.match(tokens)
            if entry is not None and entry[0] != tokens:
                merged = [a if a == b else ANY for a, b in zip(entry[0], tokens)]
                fresh = [k for k, w in enumerate(merged) if w == ANY and entry[0][k] != ANY]
                # Wildcards may not take over, nor take the place of cues.
                if merged.count(ANY) > (1 - SIMILAR) * len(merged) + len(entry[3]) / 2 or any(_is_cue(entry[0][k]) or _is_cue(tokens[k]) for k in fresh):
                    entry = None
                elif fresh:
                    entry[0], entry[2], entry[3] = merged, None, [k for k, w in enumerate(merged) if w == ANY]
            if entry is None:
                entry = [tokens, 0, None, [k for k, w in enumerate(tokens) if w == ANY]]
                self._hang(entry)
            self.exact[text] = entry
        entry[1] += count
        return entry

    def _hang(self, entry: list) -> None:
        at = self.leaf(entry[0])
        own = self.leaves.setdefault(at, [])
        own.append(entry)
        if len(own) > CROWD and len(at) - 1 < len(entry[0]):
            self.crowded.add(at)
            for e in self.leaves.pop(at):
                self.leaves.setdefault(self.leaf(e[0]), []).append(e)

    def entries(self) -> Iterator[list]:
        for own in self.leaves.values():
            yield from own


def features(tokens: list[str], without: tuple[re.Pattern, ...] = ()) -> list[str]:
    """Words, pairs of neighbouring words and beginnings of long words of a template."""
    text = " ".join(tokens)
    for cue in without:
        text = cue.sub(" ", text)
    words = [w for t in text.split() for w in ([ANY] if t == ANY else _WORD.findall(t))]
    return [*words, *(f"{a} {b}" for a, b in zip(["^", *words], [*words, "$"])), *(f"{w[:5]}-" for w in words if len(w) > 6)]


@dataclass
class Classifier:
    """Softmax regression over the features of a template, and over what mining says of it."""

    index: dict[str, int] = field(default_factory=dict)
    words: np.ndarray = field(default_factory=lambda: np.zeros((1, len(KINDS)), np.float32))
    mined: np.ndarray = field(default_factory=lambda: np.zeros((len(MINED), len(KINDS)), np.float32))
    bias: np.ndarray = field(default_factory=lambda: np.array([1.0] + [0.0] * (len(KINDS) - 1), np.float32))

    def text(self, tokens: list[str]) -> np.ndarray:
        """The part of the logits that the words give; one word alone, or words never seen, speak for an ordinary template."""
        all_found = features(tokens)
        found = [i for f in all_found if (i := self.index.get(f)) is not None]
        if not found or sum(f != ANY and " " not in f and f[-1:] != "-" for f in all_found) < 2:
            return np.eye(1, len(KINDS), dtype=np.float32)[0] * 99
        return self.bias + self.words[found].sum(axis=0) / np.sqrt(len(all_found))

    def may_be_residue(self, logits: np.ndarray) -> bool:
        """Whether some finding of mining could still make it residue: each counts from 0 to 1, so that its share is bounded."""
        most = np.maximum(self.mined[:, 1:] - self.mined[:, :1], 0).sum(axis=0)
        return bool((logits[1:] + most >= logits[0]).any())

    def kinds(self, logits: np.ndarray, mined: np.ndarray) -> np.ndarray:
        return (logits + mined @ self.mined).argmax(axis=1)


def fit(examples: list[tuple[list[str], str, tuple[float, ...] | None, tuple[re.Pattern, ...]]], epochs: int = 40, seed: int = 3) -> Classifier:
    """Fit to (tokens, kind, findings of mining or None for those of the mean, cues to do without in a second copy). Kinds weigh the same
    together as ordinary templates do. Nothing to learn from gives a classifier that calls everything ordinary."""
    made = Classifier()
    if not any(kind != KINDS[0] for _, kind, *_ in examples):
        return made
    rows = [(features(tokens), KINDS.index(kind), m) for tokens, kind, m, _ in examples]
    rows += [(features(tokens, cues), KINDS.index(kind), m) for tokens, kind, m, cues in examples if cues and len(_WORD.findall(" ".join(tokens))) > 3]
    counts = Counter(f for fs, kind, _ in rows for f in set(fs) for _ in range(1 if kind == 0 else 2))
    made.index = {f: i for i, f in enumerate(sorted(f for f, n in counts.items() if n > 1))}
    have = [m for _, _, m in rows if m is not None]
    mean = np.mean(have, axis=0) if have else np.full(len(MINED), 0.5)
    y, mined = np.array([k for _, k, _ in rows]), np.array([mean if m is None else m for _, _, m in rows], np.float32)
    at = [[made.index[f] for f in fs if f in made.index] for fs, _, _ in rows]
    n = np.bincount(y, minlength=len(KINDS))
    weight = np.array([1.0, *(min(HEAVIEST, max(1, n[0]) / max(1, k) / (len(KINDS) - 1)) for k in n[1:])])[y]
    weight /= weight.mean()
    p = {"words": np.zeros((len(made.index) + 1, len(KINDS)), np.float32), "mined": np.zeros((len(MINED), len(KINDS)), np.float32), "bias": np.zeros(len(KINDS), np.float32)}
    m1, m2 = ({k: np.zeros_like(a) for k, a in p.items()} for _ in range(2))
    rng, t = np.random.default_rng(seed), 0
    summed = lambda at, values, size: np.stack([np.bincount(at, values[:, k], size) for k in range(len(KINDS))], axis=1).astype(np.float32)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for s in range(0, len(order), 256):
            pick, t = order[s : s + 256], t + 1
            flat, rep = np.concatenate([at[i] for i in pick]).astype(int), np.repeat(np.arange(len(pick)), [len(at[i]) for i in pick])
            scale = 1 / np.sqrt([len(rows[i][0]) for i in pick])
            logits = p["bias"] + mined[pick] @ p["mined"]
            logits = logits + summed(rep, p["words"][flat] * scale[rep, None], len(pick))
            delta = np.exp(logits - logits.max(axis=1, keepdims=True))
            delta /= delta.sum(axis=1, keepdims=True)
            delta[np.arange(len(pick)), y[pick]] -= 1
            delta *= weight[pick, None] / len(pick)
            grown = summed(flat, delta[rep] * scale[rep, None], len(p["words"]))
            for k, g in {"words": grown + 1e-4 * p["words"], "mined": mined[pick].T @ delta + 3e-3 * p["mined"], "bias": delta.sum(axis=0)}.items():
                m1[k] = 0.9 * m1[k] + 0.1 * g
                m2[k] = 0.999 * m2[k] + 0.001 * g * g
                p[k] -= (0.05 * (m1[k] / (1 - 0.9**t)) / (np.sqrt(m2[k] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
    made.words, made.mined, made.bias = p["words"], p["mined"], p["bias"]
    return made


def findings(n: int, fixed: float, alone: int, lead: int, sources: int) -> tuple[float, ...]:
    return fixed, alone / n, lead / n, float(sources > 1)


def learn(docs: DataFrame) -> Classifier:
    """A classifier from the templates of a bounded sample of docs (key, source, text), by a hash of their key."""
    total = docs.count()
    sample = docs.where(F.pmod(F.xxhash64("key"), F.lit(max(1, total))) < SAMPLE)

    def grow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tree, seen = PrefixTree(), {}
        for batch in batches:
            for source, text in zip(batch["source"], batch["text"]):
                for tokens, alone, lead in lines(text):
                    if len(tokens) <= LONGEST and max(map(len, tokens)) <= 40:
                        entry = tree.add(tokens)
                        own = seen.setdefault(id(entry), [entry, 0, 0, set()])
                        own[1], own[2] = own[1] + alone, own[2] + lead
                        if len(own[3]) < 2:
                            own[3].add(source)
        rows = [(" ".join(e[0]), label(" ".join(e[0]))[0] or KINDS[0], e[1], *findings(e[1], 1 - e[0].count(ANY) / len(e[0]), a, b, len(s))) for e, a, b, s in seen.values()]
        yield pd.DataFrame(rows, columns=["template", "kind", "n", *MINED])

    mined = cut(spread(sample).mapInPandas(grow, "template string, kind string, n bigint, " + ", ".join(f"{m} double" for m in MINED)).groupBy("template", "kind").agg(F.sum("n").alias("n"), *[F.max(m).alias(m) for m in MINED]))
    # Of ordinary templates those with a word of a cue teach most, then the frequent ones.
    ordinary = F.arrays_overlap(F.split("template", " "), F.array(*[F.lit(w) for w in sorted(CUES)]))
    order = [F.xxhash64("template"), F.col("template")]
    chosen = (mined.where(F.col("kind") != KINDS[0]).orderBy(*order), mined.where((F.col("kind") == KINDS[0]) & ordinary).orderBy(*order), mined.where((F.col("kind") == KINDS[0]) & ~ordinary).orderBy(F.desc("n"), *order))
    rows = [r for part in chosen for r in part.limit(TRAIN).collect()]
    examples = [(r["template"].split(" "), r["kind"], tuple(r[m] for m in MINED), label(r["template"])[1]) for r in rows]
    return fit(examples + [(p.split(" "), kind, None, ()) for kind, phrases in PHRASES.items() for p in phrases])




def candidates(docs: DataFrame, classifier: Classifier, key: str) -> DataFrame:
    """One pass over docs (key, source, text): (key, what, template, alone, lead, source) for sentences whose templates may be
    residue (what = template), for documents with slots (slot), and for runs of words that may be filler (run)."""

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tree = PrefixTree()
        for batch in batches:
            rows = []
            for k, source, text in zip(batch["key"], batch["source"], batch["text"]):
                if _MAY_BE_SLOT.search(text) and _SLOT.search(text):
                    rows.append((k, "slot", "", False, False, source))
                    continue
                run: list[str] = []
                for tokens, alone, lead in lines(text):
                    entry = tree.add(tokens)
                    if entry[2] is None:
                        entry[2] = repeats(entry[0]) or classifier.may_be_residue(classifier.text(entry[0]))
                    if entry[2]:
                        rows.append((k, "template", " ".join(entry[0]), alone, lead, source))
                    run += tokens
                words = [w for t in run if t != ANY for w in _WORD.findall(t)]
                poor = sorted({s for s in range(0, len(words) - WINDOW + 1, WINDOW // 2) if len(set(words[s : s + WINDOW])) <= RICH * WINDOW})
                rows.extend((k, "run", " ".join(words[s : s + WINDOW]), False, False, source) for s in poor)
                if len(tree.exact) > MOST:
                    tree = PrefixTree()
            yield pd.DataFrame(rows, columns=["key", "what", "template", "alone", "lead", "source"])

    return spread(docs).mapInPandas(visit, f"key {key}, what string, template string, alone boolean, lead boolean, source string")


def mine(found: DataFrame) -> DataFrame:
    """(template, merged, n, alone, lead, sources): templates of the tasks and the template of the whole corpus each became part
    of, with its numbers, merged leaf by leaf; large leaves by further tokens."""
    own = found.where("what = 'template'").groupBy("template").agg(F.count("*").alias("n"), F.count_if("alone").alias("alone"), F.count_if("lead").alias("lead"), F.min("source").alias("s1"), F.max("source").alias("s2"))
    own = own.withColumn("tokens", F.split("template", " ")).withColumn("size", F.size("tokens")).withColumn("head", F.array_join(F.slice("tokens", 1, DEPTH), " "))
    crowd = own.groupBy("size", "head").agg(F.count("*").alias("crowd"))
    deeper = DEPTH + F.when(F.col("crowd") > GROUP, 2 * F.ceil(F.log2(F.col("crowd") / GROUP))).otherwise(0).cast("int")
    placed = own.join(crowd, ["size", "head"]).withColumn("head", F.array_join(F.slice("tokens", F.lit(1), deeper), " ")).drop("tokens", "crowd")

    def merge(leaf: pd.DataFrame) -> pd.DataFrame:
        tree, at = PrefixTree(), []
        for r in leaf.sort_values(["n", "template"], ascending=[False, True]).itertuples(index=False):
            at.append((r, tree.add(r.template.split(" "), r.n)))
        sums: dict[int, list] = {}
        for r, entry in at:
            s = sums.setdefault(id(entry), [0, 0, 0, set()])
            s[0], s[1], s[2] = s[0] + r.n, s[1] + r.alone, s[2] + r.lead
            if len(s[3]) < 2:
                s[3].update(x for x in (r.s1, r.s2) if isinstance(x, str))
        return pd.DataFrame([(r.template, " ".join(e[0]), *sums[id(e)][:3], len(sums[id(e)][3])) for r, e in at], columns=["template", "merged", "n", "alone", "lead", "sources"])

    return placed.groupBy("size", "head").applyInPandas(merge, "template string, merged string, n bigint, alone bigint, lead bigint, sources int")


def classify(mined: DataFrame, classifier: Classifier) -> DataFrame:
    """(template, merged, n, kind) of the residue templates."""

    @F.pandas_udf("string")
    def kind(merged: pd.Series, n: pd.Series, alone: pd.Series, lead: pd.Series, sources: pd.Series) -> pd.Series:
        out = []
        for m, *numbers in zip(merged, n, alone, lead, sources):
            tokens = m.split(" ")
            at = np.array([findings(numbers[0], 1 - tokens.count(ANY) / len(tokens), *numbers[1:])], np.float32)
            out.append("filler" if repeats(tokens) else KINDS[classifier.kinds(classifier.text(tokens)[None], at)[0]])
        return pd.Series(out, dtype=object)

    return mined.select("template", "merged", "n", kind("merged", "n", "alone", "lead", "sources").alias("kind")).where(F.col("kind") != KINDS[0])


def filler(found: DataFrame, docs: DataFrame) -> DataFrame:
    """Keys of documents with a sentence of filler. A word is idle if most documents that have it have it in a run of few
    different words; a sentence of idle words is filler, wherever it stands."""
    inside = found.where("what = 'run'").select("key", F.explode(F.array_distinct(F.split("template", " "))).alias("w")).distinct().groupBy("w").agg(F.count("*").alias("inside"))
    words = docs.select("key", F.explode(F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+"))).alias("w"))
    few = lambda df: F.broadcast(df) if df.count() <= FEW else df
    inside = cut(inside)
    counted = words.join(few(inside.select("w")), "w", "left_semi").groupBy("w").agg(F.count("*").alias("n"))
    idle = cut(counted.join(inside, "w").where(F.col("inside") >= IDLE * F.col("n")).select("w"))
    own = words.join(few(idle), "w", "left_semi").groupBy("key").agg(F.collect_set("w").alias("idle")).where(F.size("idle") >= 3)

    @F.pandas_udf("boolean")
    def has_filler(texts: pd.Series, idles: pd.Series) -> pd.Series:
        out = []
        for text, words_of_it in zip(texts, idles):
            known = set(words_of_it)
            each = (_WORD.findall(" ".join(tokens)) for tokens, *_ in lines(text))
            out.append(any(len(ws) >= 5 and sum(w in known for w in ws) >= 0.8 * len(ws) for ws in each))
        return pd.Series(out)

    return docs.join(own, "key").where(has_filler("text", "idle")).select("key")


def prepare(docs: DataFrame, key: str, text: str, source: str | None) -> DataFrame:
    origin = F.col(source).cast("string") if source else F.lit(None).cast("string")
    return docs.select(F.col(key).alias("key"), origin.alias("source"), F.col(text).alias("text")).where("key is not null and text is not null")


def detect(docs: DataFrame, key: str, text: str = "text", source: str | None = None) -> DataFrame:
    """Keys of the documents with residue of any kind, each once. The classifier is fitted and templates are mined when this is called."""
    rows = prepare(docs, key, text, source)
    classifier = learn(rows)
    found = cut(candidates(rows, classifier, dict(docs.dtypes)[key]))
    residue = classify(mine(found), classifier).select("template")
    by_template = found.where("what = 'template'").join(residue, "template", "left_semi").select("key")
    out = found.where("what = 'slot'").select("key").unionByName(by_template).unionByName(filler(found, rows))
    return out.distinct().withColumnRenamed("key", key)


def found(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return detect(docs, "doc_id", source="source" if "source" in docs.columns else None)


def kept(spark: SparkSession, sf: str) -> DataFrame:
    """The documents without residue, with the length of their text; repeated rows stay."""
    docs = table(spark, sf, "documents")
    return docs.join(found(spark, sf), "doc_id", "left_anti").select("doc_id", F.length("text").alias("chars"))


def templates(spark: SparkSession, sf: str) -> DataFrame:
    """Residue templates with their kind and number of sentences."""
    docs = table(spark, sf, "documents")
    rows = prepare(docs, "doc_id", "text", "source" if "source" in docs.columns else None)
    classifier = learn(rows)
    mined = classify(mine(cut(candidates(rows, classifier, "bigint"))), classifier)
    return mined.groupBy(F.col("merged").alias("template"), "kind").agg(F.max("n").alias("sentences"))


QUERIES = {"p9_found": found, "p9_kept": kept, "p9_templates": templates}
ORACLES: dict[str, str] = {}
