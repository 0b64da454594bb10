"""Toxicity of a text: a weighted grammar over clauses, with weights learned from labels.

Words of a clause become symbols: insult, threat, target, negation, reported speech, other. Three
transducers, without weights, are composed into one machine that reads a clause once: negation takes the force of the next insult or threat
(``insult`` becomes ``denied``), reported speech quotes what follows it, a
target next to an insult or threat makes it personal. Insults and threats have no transducers: they are single words, looked
up before, whose weights are added up afterwards; none of several words matches. Only clauses that hold an insult or a threat can score. A document's features are what
its clauses matched; a logistic model makes them a score from 0 to 1.

The insult words are a short fixed list and what the labels teach: words, and beginnings of words,
that occur in toxic texts and hardly elsewhere, each with its own weight of evidence.

Defined results: a null or empty text scores as a text without any match. Without labels of both
kinds the fixed list alone is used, with fixed weights. Words are runs of letters, in lower case.
No more than ``most_terms`` terms are learned.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import exp, log

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from twinloom.llm.grammar import Transducer, compose
from twinloom.session import materialize

# Fixed word lists.
INSULTS = "bastard clown disgusting dumb filth idiot loser moron pathetic scum stupid trash vermin worthless".split()
THREATS = "burn destroy hurt kill murder punish shoot stab strangle".split()
TARGETS = "you your yours he him his she her hers they them their these those people".split()
NEGATIONS = "no not never nobody nothing without neither nor isn aren wasn don doesn didn".split()
REPORTS = "said says say called calls wrote writes reported quoted claimed alleged according".split()

SYMBOLS = ["insult", "threat", "target", "negation", "report", "other"]
MATCHES = ["clause", "insult", "threat", "personal", "denied", "quoted"]


@dataclass(frozen=True)
class ToxicityConfig:
    """The model is learned from ``train_rows`` labelled documents at most, chosen by hash."""

    train_rows: int = 20_000
    #: Beginnings of words looked at, in letters.
    stems: tuple[int, ...] = (4, 5, 6)
    least_documents: int = 4
    least_z: float = 2.6
    least_precision: float = 0.9
    most_terms: int = 4096
    penalty: float = 0.01


@dataclass(frozen=True)
class ToxicityModel:
    words: dict[str, float] = field(default_factory=lambda: {w: 3.0 for w in INSULTS})
    stems: dict[str, float] = field(default_factory=dict)
    bias: float = -4.0
    weights: dict[str, float] = field(default_factory=lambda: {
        "clause": 0.0, "insult": 3.0, "threat": 2.0, "personal": 1.0, "denied": 0.2, "quoted": 0.5,
    })


def machine() -> Transducer:
    """Negation, then reported speech, then targets, then the sums: one transducer for a clause."""
    alphabet = [*SYMBOLS, "denied", "quoted"]
    strong = ("insult", "threat")
    deny: dict = {("plain", "negation"): ("armed", "negation", 0.0)}
    for k, state in enumerate(("armed", "near", "far")):  # within three words
        after = ("near", "far", "plain")[k]
        deny |= {(state, s): (after, s, 0.0) for s in ("target", "report", "other")}
        deny |= {(state, s): ("plain", "denied", 0.0) for s in strong}
        deny[state, "negation"] = ("armed", "negation", 0.0)
    quote: dict = {("plain", "report"): ("open", "report", 0.0)}
    quote |= {("open", s): ("open", "quoted", 0.0) for s in strong}
    negation, report = Transducer("plain", deny), Transducer("plain", quote)
    # A target with up to two words before an insult or threat, or right after it.
    aim: dict = {}
    following = {"seen": "late", "late": "later"}
    for state in ("none", "seen", "late", "later", "hit"):
        aim[state, "target"] = ("seen", "personal" if state == "hit" else "target", 0.0)
        aim |= {(state, s): ("hit", f"{s}+" if state in ("seen", "late", "later") else s, 0.0) for s in strong}
        aim |= {
            (state, s): (following.get(state, "none"), s, 0.0)
            for s in ("other", "report", "negation", "denied", "quoted")
        }
    target = Transducer("none", aim)
    return compose(compose(negation, report, alphabet), target, alphabet)


class ClauseMatcher:
    """Features of a text: matched clauses, and for each kind of match the evidence summed over them."""

    word = re.compile(r"[^\W\d_]+")
    clause_end = re.compile(r"[.!?;:\n]")

    def __init__(self, model: ToxicityModel):
        self.model = model
        self.machine = machine()
        self.sizes = sorted({len(stem) for stem in model.stems}, reverse=True)
        self.plain = {
            **dict.fromkeys(REPORTS, "report"), **dict.fromkeys(NEGATIONS, "negation"),
            **dict.fromkeys(TARGETS, "target"), **dict.fromkeys(THREATS, "threat"),
        }
        # One search finds the words that can start a match; clauses without one are not read.
        whole = sorted([*model.words, *THREATS], key=lambda w: (-len(w), w))
        parts = [f"(?:{'|'.join(map(re.escape, whole))})(?![^\\W\\d_])"] if whole else []
        parts += [f"(?:{'|'.join(map(re.escape, sorted(model.stems)))})"] if model.stems else []
        self.hit = re.compile(rf"(?<![^\W\d_])(?:{'|'.join(parts)})")

    def evidence(self, word: str) -> float:
        """Weight of an insult, 0 if the word is none."""
        if word in self.model.words:
            return self.model.words[word]
        return max((self.model.stems.get(word[:n], 0.0) for n in self.sizes), default=0.0)

    def features(self, text: str | None) -> list[float]:
        sums = dict.fromkeys(MATCHES, 0.0)
        lower = (text or "").lower()
        at = 0
        while hit := self.hit.search(lower, at):
            stop = self.clause_end.search(lower, hit.start())
            end = stop.start() if stop else len(lower)
            start = max((lower.rfind(mark, at, hit.start()) for mark in ".!?;:\n"), default=-1)
            self._clause(self.word.findall(lower, max(start, at), end), sums)
            at = end
        return [sums[m] for m in MATCHES]

    def _clause(self, words: list[str], sums: dict[str, float]) -> None:
        strength = [self.evidence(w) for w in words]
        symbols = ["insult" if s else self.plain.get(w, "other") for w, s in zip(words, strength)]
        sums["clause"] += 1.0
        _, written = self.machine.run(symbols)
        for symbol, weight, out in zip(symbols, strength, written):
            weight = weight or 1.0
            if out in ("insult", "threat", "denied", "quoted"):
                sums[out] += weight
            elif out.endswith("+"):
                sums[out[:-1]] += weight
                sums["personal"] += 1.0
            elif out == "personal":
                sums["personal"] += 1.0

    def score(self, features: list[float]) -> float:
        # Evidence saturates: the tenth match says less than the second.
        odds = self.model.bias + sum(
            self.model.weights[m] * log(1 + f) for m, f in zip(MATCHES, features)
        )
        return 1 / (1 + exp(-max(-30.0, min(30.0, odds))))


def _terms(rows: DataFrame, config: ToxicityConfig) -> tuple[dict[str, float], dict[str, float]]:
    """Words and beginnings of words that speak for a toxic text, with their weight of evidence."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), F.lit(1)))

    def stems_of(size: int) -> Column:
        longer = F.filter(F.col("words"), lambda w: F.length(w) > size)
        return F.transform(longer, lambda w: F.concat(F.substring(w, 1, size), F.lit("*")))

    terms = F.array_distinct(F.concat(F.col("words"), *map(stems_of, config.stems)))
    totals = rows.groupBy("toxic").count().collect()
    count = {r["toxic"]: r["count"] for r in totals}
    if not (count.get(1) and count.get(0)):
        return {}, {}
    t, c, T, C = F.col("t") + 0.5, F.col("c") + 0.5, count[1] + 1.0, count[0] + 1.0
    lift = F.log(t / (T - t)) - F.log(c / (C - c))
    found = (
        rows.select("toxic", words.alias("words")).select("toxic", F.explode(terms).alias("term"))
        .groupBy("term").agg(
            F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"),
        )
        .filter((F.col("t") >= config.least_documents) & (F.length("term") > 2))
        .filter(F.col("t") >= config.least_precision * (F.col("t") + F.col("c")))
        .withColumn("lift", lift).filter(lift / F.sqrt(1 / t + 1 / c) >= config.least_z)
        .orderBy(F.desc("t"), "term").limit(config.most_terms).collect()
    )
    learned = {r["term"]: float(r["lift"]) / 2 for r in found}
    return (
        {w: s for w, s in learned.items() if not w.endswith("*")},
        {w[:-1]: s for w, s in learned.items() if w.endswith("*")},
    )


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float) -> np.ndarray:
    """Weights of a logistic model with a bias in front, by Newton steps."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x.shape[1])
    ridge = np.full(len(w), penalty * len(x) / 100)
    ridge[0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(
            (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (p - y) + ridge * w
        )
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def learn_toxicity(labelled: DataFrame, config: ToxicityConfig = ToxicityConfig()) -> ToxicityModel:
    """A model from ``text, toxic``: at most ``train_rows`` rows, as :func:`labelled_sample` gives them."""
    rows = labelled.filter("text is not null and toxic in (0, 1)")
    rows = rows.dropDuplicates(["text", "toxic"]).select("text", F.col("toxic").cast("int"))
    rows = materialize(rows, "toxic-train")
    words, stems = _terms(rows, config)
    if not words and not stems:
        return ToxicityModel()
    # A fixed insult keeps a small weight until labels speak for it.
    model = ToxicityModel(words={**dict.fromkeys(INSULTS, 1.0), **words}, stems=stems)

    @F.pandas_udf("array<double>")
    def features(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = ClauseMatcher(model)
        for batch in batches:
            yield pd.Series([matcher.features(text) for text in batch])

    # train_rows rows of a few numbers.
    found = rows.select("toxic", features("text").alias("x")).collect()
    x = np.log1p(np.array([r.x for r in found], float))
    y = np.array([r.toxic for r in found], float)
    w = _logistic(x, y, config.penalty)
    return ToxicityModel(
        model.words, model.stems, float(w[0]), dict(zip(MATCHES, map(float, w[1:])))
    )


def labelled_sample(docs: DataFrame, labels: DataFrame, config: ToxicityConfig = ToxicityConfig()) -> DataFrame:
    """``text, toxic`` of the labelled documents whose ids have the smallest hashes."""
    known = labels.filter("doc_id is not null and toxic in (0, 1)").groupBy("doc_id")
    known = known.agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id")
    # train_rows pairs of numbers at most: small enough for every executor.
    known = F.broadcast(known.limit(config.train_rows).withColumnRenamed("doc_id", "_doc"))
    return docs.select("doc_id", "text").join(known, F.col("doc_id") == F.col("_doc")).select("text", "toxic")


def toxicity_of(text: Column, model: ToxicityModel) -> Column:
    """``score, matched`` of each text; ``matched`` has the evidence by kind of match."""

    @F.pandas_udf("score double, matched array<double>")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        matcher = ClauseMatcher(model)
        for batch in batches:
            found = [matcher.features(text) for text in batch]
            yield pd.DataFrame({"score": [matcher.score(f) for f in found], "matched": found})

    return scored(text.cast("string"))
