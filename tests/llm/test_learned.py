"""Mixing, toxicity and languages: accuracy on held-out rows, and cases by hand."""

import pytest
from helpers import HARD, documents, prose
from pyspark.sql import functions as F

from twinloom.llm import language, mixing, queries, stages, toxicity
from twinloom.llm.grammar import Transducer, compose

SF = "/root/testdata/sf0.01"


def test_languages_of_held_out_documents(spark):
    found = queries.op6_language(spark, SF).join(queries.table(spark, SF, "documents"), "doc_id")
    rows = found.filter("held_out").select("lang", "lang_pred", "score").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_hard_rows(spark):
    docs = documents(spark, [*HARD, *[(100 + k, prose(k, 60, "abcd"), "one") for k in range(5)],
                             *[(200 + k, prose(k, 60, "wxyz"), "two") for k in range(5)], (300, "12 3!", "one")])
    learned = language.learn_dictionaries(docs)
    assert sorted(learned) == ["one", "two"]
    found = docs.select("doc_id", "text", language.language_of(docs["text"], learned).alias("l")).collect()
    for row in found:
        letters = any(map(str.isalpha, row.text or ""))
        assert (row.l.lang == "und") == (not letters)
        assert letters or (row.l.score == 0 and row.l.rejected)
        if row.doc_id is not None and row.doc_id in range(100, 105):
            assert row.l.lang == "one" and not row.l.rejected
    assert language.learn_dictionaries(docs.limit(0)) == {}
    assert docs.limit(1).select(language.language_of(F.lit("abc"), {}).alias("l")).first().l.lang == "und"


def test_toxicity_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    found = queries.op5_toxicity(spark, sf).join(queries.table(spark, sf, "labels"), "doc_id")
    rows = found.filter("held_out").select("toxic", "predicted", "score").collect()
    toxic = [r for r in rows if r.toxic]
    assert sum(r.predicted for r in toxic) >= 0.85 * len(toxic)
    assert sum(r.predicted for r in rows if not r.toxic) <= 0.01 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_clauses_not_words():
    match = toxicity.ClauseMatcher(toxicity.ToxicityModel())
    plain, personal, denied, quoted, nothing = (
        dict(zip(toxicity.MATCHES, match.features(text))) for text in (
            "What trash. You are", "you are an idiot", "you are not an idiot", "they said idiot things", "you. Not said",
        )
    )
    assert plain["insult"] > 0 and plain["personal"] == 0
    assert personal["personal"] > 0 and personal["insult"] > 0
    assert denied["denied"] > 0 and denied["insult"] == 0
    assert quoted["quoted"] > 0 and quoted["insult"] == 0
    assert not any(nothing.values())
    assert not any(match.features(None)) and not any(match.features(""))
    score = toxicity.ClauseMatcher(toxicity.ToxicityModel()).score
    assert score(list(personal.values())) > score(list(denied.values())) > score(list(nothing.values()))


def test_long_texts_are_read_to_the_end():
    match = toxicity.ClauseMatcher(toxicity.ToxicityModel())
    assert match.features("x " * 100_000 + "idiot")[1] > 0
    assert match.features("idiot " * 20_000)[0] == 1


def test_composed_transducers_act_one_after_the_other():
    one = Transducer("a", {("a", "x"): ("b", "y", 1.0), ("b", "x"): ("a", "x", 0.5)}, {"b": 0.25})
    two = Transducer("p", {("p", "y"): ("q", "z", 2.0)}, {"q": 4.0})
    both = compose(one, two, ["x", "y", "z"])
    for word in ("x", "xx", "xy", "yxzx", ""):
        w1, middle = one.run(list(word))
        w2, out = two.run(middle)
        assert both.run(list(word)) == (w1 + w2, out)


def test_models_without_labels(spark):
    none = spark.createDataFrame([], "text string, toxic int")
    assert toxicity.learn_toxicity(none) == toxicity.ToxicityModel()
    docs = documents(spark, HARD)
    rows = docs.select("doc_id", toxicity.toxicity_of(docs["text"], toxicity.ToxicityModel()).alias("t")).collect()
    assert len(rows) == len(HARD) and all(0 <= r.t.score <= 1 for r in rows)


@pytest.fixture(scope="module")
def mixed(spark):
    rows = [(k, f"good {prose(k, 30)}") for k in range(60)] + [(100 + k, f"bad {prose(k, 30)}") for k in range(40)]
    labels = [(k, "good") for k in range(40)] + [(100 + k, "bad") for k in range(30)] + [(7, "bad"), (None, "bad"), (8, "odd")]
    return documents(spark, [*rows, *HARD]), spark.createDataFrame(labels, "doc_id long, domain string")


def test_mixture_meets_its_targets(spark, mixed):
    docs, labels = mixed
    weights = {"good": 3.0, "bad": 1.0}
    fit, rated, _ = mixing.domain_rates(docs, labels, weights)
    assert rated.count() == docs.count()
    total = sum(fit.present)
    assert fit.target == pytest.approx([0.75 * total, 0.25 * total])
    assert fit.reached == pytest.approx(fit.target, abs=1e-4 * total)
    rows = rated.select("rate", "tokens", F.col("_posterior").alias("p"), fit.rate(F.col("_posterior")).alias("again")).collect()
    assert all(r.rate >= 0 and sum(r.p) == pytest.approx(1) and r.again == pytest.approx(r.rate) for r in rows)
    assert sum(r.rate * r.tokens * r.p[0] for r in rows) == pytest.approx(fit.target[0], rel=1e-3)


def test_out_of_reach_targets_end(spark):
    rows = [(10, [0.6, 0.4]), (20, [0.5, 0.5])]
    table = spark.createDataFrame(rows, "tokens long, _posterior array<double>")
    fit, _ = mixing.fit_rates(table, {"a": 1.0, "b": 0.0})
    assert all(r >= 0 for r in fit.reached)
    empty, _ = mixing.fit_rates(table.limit(0), {"a": 1.0, "b": 1.0})
    assert empty.steps == [] and empty.reached == [0.0, 0.0]


def test_mixing_without_labels(spark, mixed):
    docs, labels = mixed
    for known, expected in ((labels.limit(0), [0.5, 0.5]), (labels.filter("domain = 'good'"), [1.0, 0.0])):
        posterior = mixing.fit_domains(docs, known, ["good", "bad"])
        assert {tuple(r._posterior) for r in posterior(docs.drop("_posterior")).collect()} == {tuple(expected)}


def test_copies_follow_rates(spark):
    found = spark.range(4000).select(mixing.copies(F.lit(1.25), F.col("id")).alias("n")).collect()
    assert {r.n for r in found} == {1, 2} and sum(r.n for r in found) == pytest.approx(5000, rel=0.03)


def test_documents_of_the_kept_domain_stay_once(spark):
    """Good ones with some posterior of another domain are neither thinned nor doubled; the others meet their target."""
    rows = [(k, 10 + k % 7, [1 - p, p * 0.75, p * 0.25]) for k, p in ((k, (k % 100) / 100) for k in range(1000))]
    table = spark.createDataFrame(rows, "doc_id long, tokens long, _posterior array<double>")
    fit, rated = mixing.fit_rates(table, {"good": 0.9, "poor": 0.07, "toxic": 0.03}, keep="good")
    found = rated.select("_posterior", "rate", fit.rate(F.col("_posterior")).alias("again"), mixing.copies(F.col("rate"), F.col("doc_id")).alias("n")).collect()
    assert fit.steps and len(found) == 1000
    for r in found:
        assert r.again == pytest.approx(r.rate) and 0 <= r.rate <= 1 and r.n <= 1
        assert r._posterior[0] < max(r._posterior) or r.rate == 1 and r.n == 1
    # Targets are lower than what the kept documents hold of the others, so these go.
    assert sum(r.rate for r in found if r._posterior[0] < max(r._posterior)) == pytest.approx(0, abs=1e-6)
    # Where they are not, they are met.
    fit, rated = mixing.fit_rates(table, {"good": 0.6, "poor": 0.3, "toxic": 0.1}, keep="good")
    assert fit.reached[1:] == pytest.approx(fit.target[1:], rel=1e-3)
    again, _ = mixing.fit_rates(table, {"good": 0.1, "poor": 0.6, "toxic": 0.3}, keep="good")
    assert again.steps == [] and again.reached == pytest.approx(again.present)


def test_rows_without_an_id_are_drawn_one_by_one(spark):
    rows = spark.range(2000).select(F.lit(None).cast("long").alias("doc_id"), F.sha2(F.col("id").cast("string"), 256).alias("digest"))
    found = rows.select(mixing.copies(F.lit(0.5), F.col("doc_id"), F.col("digest")).alias("n")).collect()
    assert sum(r.n for r in found) == pytest.approx(1000, rel=0.1)
