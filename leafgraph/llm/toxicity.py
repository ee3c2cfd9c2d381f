"""Toxicity by a weighted finite-state grammar over clauses.

Words become symbols: insult, threat, target, copula, determiner, mention, negation, reported speech, other.  Transducers
for each of these read the tape of a clause and mark the insults and threats in their scope; their composition is one
machine whose arcs are built as they are first taken.  What comes out of it names the pattern that the clause matches:
an insult aimed at someone, said of someone, described, piled up, or standing bare, each unless it is negated, reported or
only mentioned, and a threat that has someone it is aimed at.  A clause adds the weight of its insult to its pattern, and a
logistic model weighs the patterns.  By the prior a bare insult does not make a text toxic; labels decide what it is worth.

The insult lexicon is learned from labelled documents: words and word beginnings that stand in toxic documents far more
often than in others, in several different contexts.  The weights of the patterns are learned as well.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from leafgraph.llm.store import arrow_batches, stage, unused

#: Labelled documents of each class that the lexicon and the weights are learned from, and the most lexicon entries.
MAX_LABELLED = 8000
MAX_LEXICON = 5000
BEGINNINGS = (4, 5, 6, 7)
#: What a lexicon entry needs: log odds, toxic documents, and this share of the different contexts that as many unrelated
#: documents would show (words of near copies keep the same neighbours).  Contexts are told apart by ``CONTEXTS`` bits.
LEAST_ODDS, LEAST_DOCS, LEAST_VARIETY, CONTEXTS = 2.5, 4, 0.6, 62
#: Log odds of a seed word, and the most that one channel adds up to.
SEED_ODDS, MOST = 4.0, 15.0

# Seed words of the grammar in English, French, German and Spanish.
INSULTS = (
    "idiot idiots moron morons imbecile scumbag scum bastard loser losers stupid pathetic worthless disgusting clown trash jerk"
    " dumbass halfwit crétin abruti connard imbécile minable trottel vollidiot idioten arschloch versager abschaum imbécil"
    " gilipollas idiota estúpido basura"
)
THREATS = (
    "kill murder destroy hurt beat stab shoot strangle tuer détruire frapper töten umbringen vernichten schlagen matar"
    " destruir golpear"
)
TARGETS = "you your yours yourself u ur tu toi te vous votre du dich dir ihr euch usted ustedes vosotros ti"
COPULAS = "is are was were am be been being es est sont était suis sommes êtes ist sind war bin bist seid eres son soy fue era"
DETERMINERS = (
    "the a an this that these those such what le la les un une ce cet cette quel der die das ein eine einen dieser diese el los"
    " las una este esta ese esa qué"
)
MENTIONS = "word words term noun letters spelling spelled syllables mot terme lettres wort begriff buchstaben palabra término letras"
NEGATIONS = "not never no isn't aren't don't won't nobody ne pas jamais nicht nie kein keine nunca jamás"
REPORTING = (
    "said says say saying wrote writes called calls quoted quote according reported claims claimed dit disait écrit sagte"
    " sagt schrieb dijo dice escribió"
)

_WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
_CLAUSE = re.compile(r"[.,;:!?\n|()\[\]]+")
#: What a clause can match, and the weights before any label is seen: of nothing, then of a unit of log odds in each pattern.
PATTERNS = ("aimed", "predicated", "piled", "described", "bare", "negated", "reported", "mentioned", "threat")
_PRIOR = np.array([-2.2, 1.2, 0.9, 0.6, 0.4, 0.3, 0.3, 0.4, 0.1, 1.0])
_PULL = 0.3


class Transducer:
    """Arcs ``(state, symbol) -> (state, mark)``; a symbol without an arc of its own takes the state's default arc.

    A mark is put behind the symbol that is read, for the machines that read the tape after this one.
    """

    def __init__(self, arcs: dict[tuple[int, str], tuple[int, str]]) -> None:
        self.arcs = arcs

    def step(self, state: int, symbol: str) -> tuple[int, str]:
        return self.arcs.get((state, symbol)) or self.arcs.get((state, "*")) or (state, "")


def _fading(trigger: str, reach: int, mark: str) -> Transducer:
    """After ``trigger``, the next ``reach`` symbols are in its scope: an insult or threat there is marked."""
    arcs: dict[tuple[int, str], tuple[int, str]] = {}
    for state in range(reach + 1):
        arcs[state, trigger] = (reach, "")
        arcs[state, "*"] = (max(0, state - 1), "")
        for match in "IT":
            arcs[state, match] = (max(0, state - 1), mark if state else "")
    return Transducer(arcs)


def _lasting(trigger: str, mark: str) -> Transducer:
    """From ``trigger`` to the end of the clause."""
    arcs = {(0, trigger): (1, ""), (1, trigger): (1, "")}
    for match in "IT":
        arcs[0, match], arcs[1, match] = (0, ""), (1, mark)
    return Transducer(arcs)


class Composition:
    """Machines that read one tape, each the marks of those before it; arcs are built when they are first taken."""

    def __init__(self, *machines: Transducer) -> None:
        self.machines, self.start = machines, (0,) * len(machines)
        self._arcs: dict[tuple[tuple[int, ...], str], tuple[tuple[int, ...], str]] = {}

    def step(self, states: tuple[int, ...], symbol: str) -> tuple[tuple[int, ...], str]:
        arc = self._arcs.get((states, symbol))
        if arc is None:
            then, marks = [], ""
            for machine, state in zip(self.machines, states, strict=True):
                state, mark = machine.step(state, symbol)
                then.append(state)
                marks += mark
            arc = self._arcs[states, symbol] = (tuple(then), marks)
        return arc


#: Symbols: I insult, T threat, P target, C copula, D determiner, M mention, N negation, R reported speech, o other.
#: Marks: a aimed, c predicated, d described, m mentioned, n negated, r reported, p after another insult.
GRAMMAR = Composition(
    _fading("P", 4, "a"), _fading("C", 3, "c"), _fading("D", 2, "d"), _fading("M", 2, "m"), _fading("N", 3, "n"), _lasting("R", "r"),
    Transducer({(0, "I"): (1, ""), (1, "I"): (1, "p")}),
)
#: What may also follow ("idiot that you are", "idiot is a word"): over the clause read backwards.
AFTER = Composition(_fading("P", 4, "a"), _fading("M", 3, "m"), Transducer({(0, "I"): (1, ""), (1, "I"): (1, "p")}))
#: The pattern of an insult is the first of these whose mark it has.
_ORDER = (("n", "negated"), ("r", "reported"), ("m", "mentioned"), ("a", "aimed"), ("c", "predicated"), ("p", "piled"), ("d", "described"))


def matches(symbols: list[str]) -> Iterator[tuple[int, str]]:
    """The places of a clause where a pattern matches, and which."""
    marks: dict[int, str] = {}
    states = GRAMMAR.start
    for i, symbol in enumerate(symbols):
        states, found = GRAMMAR.step(states, symbol)
        if symbol in "IT":
            marks[i] = found
    states = AFTER.start
    for i in range(len(symbols) - 1, -1, -1):
        states, found = AFTER.step(states, symbols[i])
        if i in marks:
            marks[i] += found
    for i, found in marks.items():
        if symbols[i] == "T" and "a" not in found:  # a threat needs someone it is aimed at
            continue
        pattern = next((name for mark, name in _ORDER if mark in found), "bare")
        yield i, "threat" if symbols[i] == "T" and pattern == "aimed" else pattern


@dataclass
class Model:
    words: dict[str, float] = field(default_factory=lambda: {w: SEED_ODDS for w in INSULTS.split()})
    beginnings: dict[str, float] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: _PRIOR.copy())

    def __post_init__(self) -> None:
        self._lengths = sorted({len(b) for b in self.beginnings})
        kinds = (("D", DETERMINERS), ("C", COPULAS), ("M", MENTIONS), ("R", REPORTING), ("N", NEGATIONS), ("P", TARGETS), ("T", THREATS))
        self._symbols = {word: symbol for symbol, words in kinds for word in words.split()}
        self._alarms = set(self.words) | set(THREATS.split())

    def insult(self, word: str) -> float:
        weight = self.words.get(word, 0.0)
        for n in self._lengths:
            if len(word) > n:
                weight = max(weight, self.beginnings.get(word[:n], 0.0))
        return weight

    def channels(self, text: str | None) -> np.ndarray:
        """What the matched clauses of a text add up to, by pattern, at most ``MOST`` each."""
        sums = np.zeros(len(PATTERNS))
        lowered = (text or "").lower()
        seen = {m.group() for m in _WORD.finditer(lowered)}
        if seen.isdisjoint(self._alarms) and not any(
            not self.beginnings.keys().isdisjoint([w[:n] for w in seen if len(w) > n]) for n in self._lengths
        ):
            return sums
        known = {w: x for w in seen if (x := self.insult(w)) > 0}
        kind = {w: "I" if w in known else self._symbols.get(w, "o") for w in seen}
        for clause in _CLAUSE.split(lowered):
            words = _WORD.findall(clause)
            symbols = [kind[w] for w in words]
            if "I" in symbols or "T" in symbols:
                for i, pattern in matches(symbols):
                    sums[PATTERNS.index(pattern)] += known.get(words[i], SEED_ODDS)
        return np.minimum(sums, MOST)

    def score(self, text: str | None) -> float:
        z = float(self.weights[0] + self.weights[1:] @ self.channels(text))
        return 1.0 / (1.0 + math.exp(-max(-60.0, min(60.0, z))))


def _evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each batch and each word or beginning: in how many documents of each class, and a bit set of contexts."""
    for batch in batches:
        counts: dict[str, list[int]] = defaultdict(lambda: [0, 0, 0])
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            words = _WORD.findall((text or "").lower())
            bits: dict[str, int] = defaultdict(int)
            for i, word in enumerate(words):
                around = f"{words[i - 1] if i else ''} {words[i + 1] if i + 1 < len(words) else ''}"
                bit = 1 << zlib.crc32(around.encode()) % CONTEXTS if toxic else 0
                bits["=" + word] |= bit
                for n in BEGINNINGS:
                    if len(word) > n:
                        bits[word[:n]] |= bit
            for name, bit in bits.items():
                entry = counts[name]
                entry[0 if toxic else 1] += 1
                entry[2] |= bit
        rows = counts.values()
        columns = [pa.array(list(counts), pa.string()), *(pa.array([r[k] for r in rows], pa.int64()) for k in range(3))]
        yield pa.record_batch(columns, names=("name", "toxic", "clean", "contexts"))


def _fit(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Logistic weights from the prior, with Gaussian pull towards it: Newton's method, steps halved while they do harm."""
    x = np.hstack([np.ones((len(x), 1)), x])

    def loss(b: np.ndarray) -> float:
        z = x @ b
        return float((np.logaddexp(0.0, z) - y * z).sum() + 0.5 * _PULL * ((b - _PRIOR) ** 2).sum())

    b, now = _PRIOR.copy(), loss(_PRIOR)
    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ b, -30, 30)))
        gradient = x.T @ (y - p) - _PULL * (b - _PRIOR)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + _PULL * np.eye(len(b)), gradient)
        size = 1.0
        while size > 1e-6 and (then := loss(b + size * step)) > now:
            size /= 2
        if size <= 1e-6 or now - then < 1e-9:
            break
        b, now = b + size * step, then
    b[1:] = np.maximum(b[1:], 0.0)
    return b


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Model:
    """Learn from ``docs(doc_id, text)`` and ``labels(doc_id, toxic)``.

    Of each class at most about ``max_labelled`` documents are taken, by a hash of the id.  A document that has several
    labels is toxic if one of them says so.  Null ids and labels are left out; without toxic or without clean labels the
    grammar's seed words and prior weights are the model.
    """
    arrow_batches(docs.sparkSession)
    label = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").alias("__id"))
    label = label.agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in label.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        return Model()
    draw = F.pmod(F.xxhash64("__id", F.lit("toxicity")), F.lit(1 << 30))
    shares = {k: int(min(1.0, max_labelled / n) * (1 << 30)) for k, n in sizes.items()}
    drawn = label.where(draw < F.when(F.col("toxic") == 1, shares[1]).otherwise(shares[0]))
    # at most about 2 * max_labelled ids
    known = docs.select("doc_id", "text").join(F.broadcast(drawn), F.col("doc_id") == F.col("__id"))
    known = stage(known.select("text", "toxic").dropDuplicates(["text", "toxic"]), "labelled")
    totals = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    if not toxic or not clean:
        return Model()
    counted = known.mapInArrow(_evidence, "name string, toxic long, clean long, contexts long")
    counted = counted.groupBy("name").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"), F.bit_or("contexts").alias("x"))
    odds = F.log((F.col("t") + 0.5) / (toxic + 1.0)) - F.log((F.col("c") + 0.5) / (clean + 1.0))
    counted = stage(counted.where(F.col("t") >= 2), "evidence")
    # that chance puts a word into that many toxic documents must be unlikely even once among all words (Chernoff's bound)
    both, rate = F.col("t") + F.col("c"), toxic / (toxic + clean)
    surprise = F.col("t") * F.log(F.col("t") / both / rate) + F.when(
        F.col("c") > 0, F.col("c") * F.log(F.col("c") / both / (1.0 - rate))
    ).otherwise(0.0)
    expected = CONTEXTS * (1.0 - F.pow(F.lit(1.0 - 1.0 / CONTEXTS), F.col("t")))
    enough = (F.col("t") >= LEAST_DOCS) & (F.bit_count("x") >= LEAST_VARIETY * expected) & (surprise >= math.log(max(1, counted.count())))
    known_words = counted.where(F.col("name").startswith("="))
    # a beginning counts if no single word stands for most of it
    heads = [known_words.where(F.length("name") > n + 1).select(F.substring("name", 2, n).alias("name"), "t") for n in BEGINNINGS]
    heads = reduce(DataFrame.union, heads).groupBy("name").agg(F.max("t").alias("one"))
    beginnings = counted.join(heads, "name").where(2 * F.col("one") <= F.col("t")).drop("one")
    best = known_words.union(beginnings).withColumn("odds", odds).where(enough & (F.col("odds") >= LEAST_ODDS))
    best = best.orderBy(F.desc("t"), "name").limit(MAX_LEXICON).select("name", "odds").collect()
    words = {w: SEED_ODDS for w in INSULTS.split()} | {r["name"][1:]: r["odds"] for r in best if r["name"][0] == "="}
    model = Model(words, {r["name"]: r["odds"] for r in best if r["name"][0] != "="})

    def channels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([model.channels(t) for t in batch.column("text").to_pylist()]).reshape(-1, len(PATTERNS))
            yield pa.record_batch([batch.column("toxic"), *(pa.array(x[:, k]) for k in range(len(PATTERNS)))], names=("toxic", *PATTERNS))

    shape = "toxic int, " + ", ".join(f"{c} double" for c in PATTERNS)
    seen = known.select("text", "toxic").mapInArrow(channels, shape).toPandas()
    return Model(model.words, model.beginnings, _fit(seen[list(PATTERNS)].to_numpy(), seen["toxic"].to_numpy(dtype=float)))


def score_column(model: Model) -> Callable[[Column], Column]:
    """A column function: text to score between 0 and 1.  Null and empty texts score as texts without a match."""

    @pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return texts.map(model.score, na_action=None)

    return score


def drop_toxic(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns, whatever they are called.

    Null and empty texts score as texts without a match; repeated rows and rows with a null id are judged like any other.
    """
    arrow_batches(docs.sparkSession)
    score = unused("toxicity", docs)
    kept = docs.withColumn(score, score_column(model)(F.col("text"))).where(F.col(score) < threshold)
    return kept.drop(score)
