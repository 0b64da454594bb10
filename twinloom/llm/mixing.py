"""Mixing documents to target weights of domains that each belongs to only in part.

A classifier, fitted to a table of labelled documents, gives each document a probability for every
domain. A document's rate says how often it is to be used; with rates r, tokens w and probabilities
p the expected tokens of domain d are sum(r * w * p[d]). Rates start at 1 and follow projected gradient
descent on half the sum of (expected - target)**2 / present over the domains: each step subtracts
from every rate the sum of p[d] * (expected - target)[d] / present[d] and cuts at 0. (The gradient
is taken in the metric of the tokens, where its largest eigenvalue is 1, so a step of 1 is
safe.) Scaled by how the totals bend with each other a step goes further, straight to the targets where no
rate is cut; it is taken where it brings the sum down, else the plain one. A step needs a few sums over all documents; the numbers of a step, not
the documents, pass through the driver.

With a domain to keep, a document of which no other domain is likelier has a rate of 1 throughout, and the others one from 0 to 1:
only they are thinned, and none comes twice. Steps then serve the domains that have more than their target; of the others
all is kept that no thinned document takes along.

Defined results: a null or empty text has no tokens and weighs nothing, but gets probabilities and a rate. Without
labelled documents all domains are equally likely; with one labelled domain it is certain. A domain
without any expected tokens keeps none. Rows that repeat are documents of their own. Other columns, of any name, stay.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from twinloom.session import materialize

#: Marks that hardly occur in prose; fixed, one character each.
MARKS = "#$%&*|{}<>=~^\\"


@dataclass(frozen=True)
class MixConfig:
    """The classifier is fitted to ``train_rows`` labelled documents at most, chosen by hash."""

    train_rows: int = 20_000
    features: int = 1 << 15
    fit_iterations: int = 25
    regularization: float = 1e-3
    steps: int = 200
    #: Done when no domain is further from its target than this share of all tokens.
    tolerance: float = 1e-6
    #: Rates are written to the shared folder after so many steps.
    keep_after: int = 10


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"\s+"), lambda w: w != "")


def token_count(text: Column) -> Column:
    """Words between white space."""
    return F.size(_words(text)).cast("long")


def with_features(docs: DataFrame, config: MixConfig) -> DataFrame:
    """``docs`` with ``_features``: which words occur, how few differ, and the share of marks."""
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    size = F.greatest(F.length(text), F.lit(1))
    words = docs.withColumn("_words", _words(docs["text"])).withColumn("_distinct", F.array_distinct("_words"))
    dense = words.withColumn(
        "_same", 1 - F.size("_distinct") / F.greatest(F.size("_words"), F.lit(1))
    ).withColumn(
        "_marks", F.sqrt((size - F.length(F.translate(text, MARKS, ""))) / size)
    )
    hashed = HashingTF(
        numFeatures=config.features, binary=True, inputCol="_distinct", outputCol="_hashed"
    ).transform(dense)
    joined = VectorAssembler(inputCols=["_hashed", "_same", "_marks"], outputCol="_features")
    # The assembler describes each feature by a name: a megabyte in every plan and file, read by nothing.
    return joined.transform(hashed).withColumn("_features", F.col("_features").alias("_features", metadata={})).drop(
        "_words", "_distinct", "_same", "_marks", "_hashed"
    )


def fit_domains(
    docs: DataFrame, labels: DataFrame, domains: list[str], config: MixConfig = MixConfig()
) -> Callable[[DataFrame], DataFrame]:
    """A function that adds ``_posterior``, an array of the probabilities of ``domains``.

    ``labels`` (``doc_id, domain``) names the domain of some documents; others than ``domains`` are
    not learned. Of a document labelled twice the first domain in order counts.
    """
    place = F.array_position(F.array(*map(F.lit, domains)), F.col("domain")) - 1
    known = labels.filter("doc_id is not null").groupBy("doc_id").agg(F.min("domain").alias("domain"))
    known = known.filter(F.col("domain").isin(*domains)).select(
        F.col("doc_id").alias("_doc"), place.cast("double").alias("_label")
    )
    # train_rows pairs of numbers at most: small enough for every executor.
    known = F.broadcast(known.orderBy(F.xxhash64("_doc"), "_doc").limit(config.train_rows))
    rows = docs.select("doc_id", "text").join(known, F.col("doc_id") == F.col("_doc"))
    # Copies of a text count once.
    rows = materialize(
        with_features(rows, config).select(
            "_label", "_features", F.xxhash64("text").alias("_text")
        ).dropDuplicates(["_text", "_label"]).drop("_text"),
        "mix-train",
    )
    seen = sorted(int(r[0]) for r in rows.select("_label").distinct().collect())
    if len(seen) < 2:
        share = [1.0 if d == seen[0] else 0.0 for d in range(len(domains))] if seen else [1 / len(domains)] * len(domains)
        return lambda df: df.withColumn("_posterior", F.array(*map(F.lit, share)))
    model = LogisticRegression(
        featuresCol="_features", labelCol="_label", probabilityCol="_probability", family="multinomial",
        maxIter=config.fit_iterations, regParam=config.regularization,
    ).setPredictionCol("").setRawPredictionCol("").fit(rows)
    given = model.numClasses  # domains after the last one seen have no place in the model

    def posterior(df: DataFrame) -> DataFrame:
        found = vector_to_array("_probability")
        padded = F.concat(found, F.array(*[F.lit(0.0)] * (len(domains) - given))) if given < len(domains) else found
        return model.transform(with_features(df, config)).withColumn("_posterior", padded).drop(
            "_features", "_probability"
        )

    return posterior


@dataclass(frozen=True)
class Mix:
    """Targets and result of a fit; ``steps`` holds, for each step, what a domain takes off."""

    domains: list[str]
    present: list[float]
    target: list[float]
    reached: list[float]
    steps: list[list[float]]
    keep: str | None = None

    def rate(self, posterior: Column) -> Column:
        return moved_rate(F.lit(1.0), posterior, self.steps, self.domains, self.keep)


def moved_rate(
    rate: Column, posterior: Column, steps: list[list[float]], domains: list[str], keep: str | None
) -> Column:
    """A rate after some steps. These are data of the expression, so that the code made for it stays the same."""
    if not steps:
        return rate
    moves = F.array(*[F.array(*map(F.lit, step)) for step in steps])
    return F.aggregate(
        moves, rate,
        lambda r, step: bounded(
            r - sum(posterior[d] * step[d] for d in range(len(domains))), posterior, domains, keep
        ),
    )


def stays(posterior: Column, domains: list[str], keep: str) -> Column:
    """Whether no other domain is likelier than ``keep``."""
    return posterior[domains.index(keep)] >= F.array_max(posterior)


def bounded(rate: Column, posterior: Column, domains: list[str], keep: str | None) -> Column:
    """The nearest allowed rate."""
    rate = F.greatest(F.lit(0.0), rate)
    return rate if keep is None else F.when(stays(posterior, domains, keep), 1.0).otherwise(F.least(F.lit(1.0), rate))


def fit_rates(
    posteriors: DataFrame, weights: dict[str, float], config: MixConfig = MixConfig(),
    keep: str | None = None,
) -> tuple[Mix, DataFrame]:
    """Rates that bring the domains to ``weights``, and ``posteriors`` with ``rate``.

    ``posteriors`` has ``tokens`` and ``_posterior``. The total stays as it is; with ``keep`` it is
    chosen by the tokens of this domain, and its documents stay whole.
    """
    domains = list(weights)
    if any(w < 0 for w in weights.values()) or not sum(weights.values()):
        raise ValueError("weights are nonnegative and not all 0")
    share = [w / sum(weights.values()) for w in weights.values()]
    parts = [F.col("_posterior")[d] for d in range(len(domains))]

    size = len(domains)

    def measure(df: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """Expected tokens of each domain, and how these change with each other's rates (of rates above 0)."""
        free = F.col("rate") > 0
        if keep is not None:
            free &= ~stays(F.col("_posterior"), domains, keep)
        used = F.col("tokens") * F.when(free, 1.0).otherwise(0.0)
        sums = [F.sum(F.col("rate") * F.col("tokens") * p) for p in parts]
        sums += [F.sum(used * p * q) for p in parts for q in parts]
        found = np.array([v or 0.0 for v in df.agg(*sums).first()])
        return found[:size], found[size:].reshape(size, size)

    rated = posteriors.withColumn("rate", F.lit(1.0))
    reached, curvature = measure(rated)
    present = reached
    total = float(present.sum())
    if keep is not None:
        total = float(present[domains.index(keep)]) / share[domains.index(keep)]
    target = np.array(share) * total
    aims = np.array([d for d in range(size) if keep is None or d != domains.index(keep) and present[d] > target[d]], int)
    steps: list[list[float]] = []
    kept = 0  # steps that the stored rates have taken
    scaled = True
    while len(steps) < config.steps and np.abs(reached - target)[aims].max(initial=0.0) > config.tolerance * total:
        off = reached - target
        step = np.zeros(size)
        # Scaled by the curvature the step would be exact, were no rate cut at its bounds.
        step[aims] = (
            np.linalg.lstsq(curvature[np.ix_(aims, aims)], off[aims], rcond=1e-12)[0] if scaled
            else np.divide(off, present, out=np.zeros(size), where=present > 0)[aims]
        )
        since = [*steps[kept:], step.tolist()]
        moved = rated.withColumn("rate", moved_rate(F.col("rate"), F.col("_posterior"), since, domains, keep))
        now, bend = measure(moved)

        def miss(sums: np.ndarray) -> float:
            return float(np.divide((sums - target) ** 2, present, out=np.zeros(size), where=present > 0)[aims].sum())

        if miss(now) >= miss(reached) * (1 - 1e-9):
            if not scaled:
                break  # the rest of the way is barred: a target cannot be reached with allowed rates
            scaled = False
            continue
        scaled = True
        steps.append([float(v) for v in step])
        reached, curvature = now, bend
        if len(steps) - kept == config.keep_after:
            rated, kept = materialize(moved, "mix-rates"), len(steps)
    rated = rated.withColumn("rate", moved_rate(F.col("rate"), F.col("_posterior"), steps[kept:], domains, keep))
    present, target, reached = (x.tolist() for x in (present, target, reached))
    return Mix(domains, present, target, reached, steps, keep), rated


def copies(rate: Column, *keys: Column) -> Column:
    """How often to use a document: the rate, rounded up for a share of keys equal to its fraction."""
    uniform = F.pmod(F.xxhash64(*keys, F.lit("copies")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return F.floor(rate + uniform).cast("int")


def domain_rates(
    docs: DataFrame, labels: DataFrame, weights: dict[str, float], config: MixConfig = MixConfig(),
    keep: str | None = None,
) -> tuple[Mix, DataFrame, Callable[[DataFrame], DataFrame]]:
    """The fit, ``doc_id, tokens, _posterior, rate`` of each row, and the classifier."""
    posterior = fit_domains(docs, labels, list(weights), config)
    narrow = posterior(docs.select("doc_id", "text")).select(
        "doc_id", token_count(F.col("text")).alias("tokens"), "_posterior"
    )
    mix, rated = fit_rates(materialize(narrow, "mix-posteriors"), weights, config, keep)
    return mix, rated, posterior
