"""Personal data in texts: labelers vote on candidate spans, a classifier learned from the votes decides.

1. Candidates are the spans of exact patterns (the base) and of looser ones: numbers in groups without a plus,
   card-like numbers that fail their check digit, dotted numbers out of range, masked addresses.
2. Labelers vote yes, no or not at all on each: ``pattern`` (the exact rule), ``gazetteer`` (known top-level domains,
   card and country prefixes), ``before`` (words ahead), ``around`` (what touches the span), ``shape``
   (digits that are all alike or run on).
3. Spark counts how often each pattern of votes and features occurs, over all documents. Expectation-maximisation
   estimates for each kind how common true spans are and how reliable each labeler is, and with that how
   likely each pattern of votes is a true span.
4. A logistic model of the spans' features is fitted to these likelihoods. A candidate with at least ``threshold``
   becomes a span; base spans always are, and what fails its check digit or range never is.

Only counts of patterns, of which there are a bounded number, pass through the driver.

Defined results: null and empty texts have no spans. Added spans do not overlap others. Places are
code points, the end is exclusive. An empty table has a model that adds nothing.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

KINDS = ["email", "ip", "card", "phone"]
LABELERS = ["pattern", "gazetteer", "before", "around", "shape"]
YES, NO, SILENT = 1, 0, 2

# Fixed patterns of the base.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
LOCAL_SET = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# The look-behinds change no match: a number's first digit is where its pattern would match first.
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# Looser ones.
MASKED_AT = re.compile(r" ?[(\[]at[)\]] ?")
MASKED_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?: ?(?:\.|[(\[]dot[)\]]) ?[A-Za-z0-9-]+)+")
GROUPED = re.compile(r"(?<![0-9+.-])(?:00[1-9][0-9]{0,2}[ ./-]?)?\(?[0-9]{2,5}\)?[ ./-][0-9]{3,4}[ ./-]?[0-9]{3,4}(?![0-9])")

# Fixed word lists.
DOMAINS = set("com org net edu gov info io co de fr es it uk eu us ch at nl be example test invalid local".split())
CALLING = tuple("1 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 60 61 62 63 64 65 66 7 81 82 84 86 90 91 92 351 353 358".split())
ISSUERS = tuple("4 51 52 53 54 55 22 23 24 25 26 27 34 37 30 36 38 6011 65 35 62".split())
SPEAKS_FOR = {
    "email": set("mail email contact write courriel correo adresse".split()),
    "ip": set("ip host server address client from login adresse".split()),
    "card": set("card visa mastercard amex credit debit carte tarjeta karte pay payment".split()),
    "phone": set("phone tel call mobile fax telephone telefon teléfono téléphone whatsapp contact".split()),
}
SPEAKS_AGAINST = set("version release build isbn issn order invoice ticket token key id sha doi page section".split())
WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class PiiConfig:
    threshold: float = 0.5
    rounds: int = 50
    #: Votes that each labeler counts as having cast rightly and wrongly beforehand.
    right: float = 4.0
    wrong: float = 1.0
    penalty: float = 1.0


def luhn(digits: str) -> bool:
    total = 0
    for k, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + k % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _local_start(text: str, at: int, free: int) -> int:
    """Where the part of an address before ``at`` starts, as long as it can be but not before ``free``."""
    while at > free and text[at - 1] in LOCAL_SET:
        at -= 1
    return at


def _masked_emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost addresses written with ``(at)`` or ``[at]``, found from there outwards."""
    free = 0
    for at in MASKED_AT.finditer(text):
        start = _local_start(text, at.start(), free)
        domain = MASKED_DOMAIN.match(text, at.end()) if start < at.start() else None
        if domain:
            yield start, domain.end()
            free = domain.end()


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost addresses, found from their ``@``: the part before it is as long as it can be."""
    free = 0
    at = text.find("@")
    while at >= 0:
        start = _local_start(text, at, free)
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            free = domain.end()
        at = text.find("@", max(at + 1, free))


def base_and_failed(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """Spans of the exact patterns, and matches of them that fail their check."""
    good = [(s, e, "email") for s, e in _emails(text)] if "@" in text else []
    bad = []
    for match in IP.finditer(text):
        fits = all(len(p) <= 3 and int(p or "0") <= 255 for p in (p.lstrip("0") for p in match.group().split(".")))
        (good if fits else bad).append((*match.span(), "ip"))
    for match in CARD.finditer(text):
        if match.end() - match.start() >= 12:
            digits = digits_of(match.group())
            if 12 <= len(digits) <= 19:
                (good if luhn(digits) else bad).append((*match.span(), "card"))
    if "+" in text:
        for match in PHONE.finditer(text):
            if 9 <= len(digits_of(match.group())) <= 15:
                good.append((*match.span(), "phone"))
    place = KINDS.index
    return sorted(good, key=lambda s: (s[0], place(s[2]))), bad


def candidates(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """Base spans, and others that might be personal data; those overlap neither base spans nor each other."""
    base, more = base_and_failed(text)
    if "(at" in text or "[at" in text:
        more += [(*span, "email") for span in _masked_emails(text)]
    more += [(*m.span(), "phone") for m in GROUPED.finditer(text) if 9 <= len(digits_of(m.group())) <= 15]
    if not more:
        return base, []
    taken: list[list[int]] = []  # what base spans cover, apart and in order
    for start, end, _ in base:
        if taken and start < taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], end)
        else:
            taken.append([start, end])
    free, last, at = [], 0, 0
    for start, end, kind in sorted(more, key=lambda s: (s[0], KINDS.index(s[2]))):
        while at < len(taken) and taken[at][1] <= start:
            at += 1
        if start >= last and (at == len(taken) or end <= taken[at][0]):
            free.append((start, end, kind))
            last = end
    return base, free


def describe(text: str, start: int, end: int, kind: str, base: bool) -> tuple[list[int], list[int]]:
    """Votes of the labelers on a span, and its features (0 or 1)."""
    said = text[start:end]
    digits = digits_of(said)
    if kind == "email":
        known = YES if re.split(r"[.)\] ]+", said.lower())[-1] in DOMAINS else NO
    elif kind == "phone":
        known = YES if digits.removeprefix("00").startswith(CALLING) and said[0] in "+0" else SILENT
    elif kind == "card":
        known = YES if digits.startswith(ISSUERS) else SILENT
    else:
        known = NO if digits.startswith("0") else SILENT
    ahead = [w.lower() for w in WORD.findall(text[max(0, start - 40) : start])][-4:]
    speaks_for = not SPEAKS_FOR[kind].isdisjoint(ahead)
    against = not SPEAKS_AGAINST.isdisjoint(ahead)
    before = NO if against else YES if speaks_for else SILENT
    left, right = text[start - 1 : start] if start else " ", text[end : end + 1] or " "
    inside = left.isalnum() or right.isalnum() or left in "=\"'_/" or right in "=_/"
    alike = len(set(digits)) <= 2 if kind != "email" else False
    running = digits[:8] in "01234567890123456789" if len(digits) >= 8 else False
    votes = [YES if base else NO, known, before, NO if inside else YES, NO if alike or running else SILENT]
    features = [
        int(base), int(known == YES), int(known == NO), int(speaks_for), int(against), int(inside),
        int(alike or running), int(any(c in " ().-" for c in said)),
    ]
    return votes, features


def pattern_counts(docs: DataFrame) -> DataFrame:
    """``kind, votes, features, n``: how often each occurs among the candidates of all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter = Counter()
            for text in batch.column(0):
                text = text.as_py() or ""
                base, more = candidates(text)
                for spans, is_base in ((base, True), (more, False)):
                    for start, end, kind in spans:
                        votes, features = describe(text, start, end, kind, is_base)
                        seen[kind, "".join(map(str, votes)), "".join(map(str, features))] += 1
            columns = [pa.array([k[i] for k in seen], pa.string()) for i in range(3)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(seen.values(), pa.int64())], names=["kind", "votes", "features", "n"]
            )

    found = docs.select(F.col("text").cast("string")).mapInArrow(count, "kind string, votes string, features string, n long")
    return found.groupBy("kind", "votes", "features").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class PiiModel:
    #: For each kind and labeler, how often a true span gets its yes and a false one its no.
    reliability: dict[str, list[tuple[float, float]]]
    weights: dict[str, list[float]]
    threshold: float

    def chance(self, kind: str, features: list[int]) -> float:
        weights = self.weights.get(kind)
        if not weights:
            return 0.0
        odds = weights[0] + sum(w * f for w, f in zip(weights[1:], features))
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def estimate(votes: np.ndarray, n: np.ndarray, config: PiiConfig) -> tuple[np.ndarray, np.ndarray]:
    """How likely each row of votes is a true span, and the labelers' reliabilities, by EM."""
    yes, no = votes == YES, votes == NO
    likely = (yes.sum(1) + 1.0) / (yes.sum(1) + no.sum(1) + 2.0)
    right = np.empty((votes.shape[1], 2))
    for _ in range(config.rounds):
        true, false = (n * likely)[:, None], (n * (1 - likely))[:, None]
        right[:, 0] = ((true * yes).sum(0) + config.right) / ((true * (yes | no)).sum(0) + config.right + config.wrong)
        right[:, 1] = ((false * no).sum(0) + config.right) / ((false * (yes | no)).sum(0) + config.right + config.wrong)
        prior = (true.sum() + 1) / (n.sum() + 2)
        odds = np.log(prior / (1 - prior)) + yes @ np.log(right[:, 0] / (1 - right[:, 1])) + no @ np.log((1 - right[:, 0]) / right[:, 1])
        updated = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        if np.abs(updated - likely).max() < 1e-9:
            break
        likely = updated
    return likely, right


def learn_pii(docs: DataFrame, config: PiiConfig = PiiConfig()) -> PiiModel:
    """Reliabilities and span classifier from the candidates of all ``docs`` (``text``)."""
    rows = pattern_counts(docs).collect()
    rows.sort(key=lambda r: (r.kind, r.votes, r.features))
    reliability, weights = {}, {}
    for kind in KINDS:
        own = [r for r in rows if r.kind == kind]
        if not own:
            continue
        votes = np.array([[int(v) for v in r.votes] for r in own])
        n = np.array([r.n for r in own], float)
        likely, right = estimate(votes, n, config)
        x = np.hstack([np.ones((len(own), 1)), [[int(f) for f in r.features] for r in own]])
        w = np.zeros(x.shape[1])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            gradient = x.T @ (n * (p - likely)) + config.penalty * w
            step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + config.penalty * np.eye(len(w)), gradient)
            w -= step
            if np.abs(step).max() < 1e-9:
                break
        reliability[kind] = [tuple(map(float, r)) for r in right]
        weights[kind] = [float(v) for v in w]
    return PiiModel(reliability, weights, config.threshold)


def spans_of(text: Column, model: PiiModel) -> Column:
    """``base`` and ``spans`` of each text: arrays of ``start, end, kind``, spans with those added."""
    span = "array<struct<start:int,end:int,kind:string>>"

    @F.pandas_udf(f"base {span}, spans {span}")
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        keys = ("start", "end", "kind")
        for batch in batches:
            found = []
            for text in batch:
                base, more = candidates(text or "")
                # What fails its own check digit or range teaches the model, but is never added.
                failed = set(base_and_failed(text)[1]) if more else ()
                added = [
                    s for s in more
                    if s not in failed and model.chance(s[2], describe(text, *s, False)[1]) >= model.threshold
                ]
                every = sorted([*base, *added], key=lambda s: (s[0], KINDS.index(s[2])))
                found.append([[dict(zip(keys, s)) for s in spans] for spans in (base, every)])
            yield pd.DataFrame(found, columns=["base", "spans"])

    return find(text.cast("string"))


def spelled(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
