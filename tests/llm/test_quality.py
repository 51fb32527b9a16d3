"""Positive-unlabelled quality: the risk, the prior, the features, and fitted models."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gradeloom.llm import quality
from gradeloom.llm.words import Hashes


def plain_risk(g, good, pi):
    """The risk as published, and which case it is in."""
    loss = lambda m: np.log1p(np.exp(-m))
    bad = loss(-g[~good]).mean() - pi * loss(-g[good]).mean()
    return pi * loss(g[good]).mean() + max(0.0, bad), bad


@pytest.mark.parametrize("shift", [-3.0, 0.0, 3.0])
def test_slopes_are_those_of_the_risk(shift):
    rng = np.random.default_rng(1)
    good = rng.random(40) < 0.4
    g = rng.normal(size=40) + np.where(good, shift, -shift)
    got = quality.risk_slopes(g, good, 0.7, 0.0, 1.0)
    risk, bad = plain_risk(g, good, 0.7)
    for i in range(40):
        step = np.zeros(40)
        step[i] = 1e-6
        if bad >= 0:
            want = (plain_risk(g + step, good, 0.7)[0] - plain_risk(g - step, good, 0.7)[0]) / 2e-6
        else:  # back up on the second term
            want = -(plain_risk(g + step, good, 0.7)[1] - plain_risk(g - step, good, 0.7)[1]) / 2e-6
        assert got[i] == pytest.approx(want, abs=1e-6)


def test_both_cases_occur():
    g, good = np.array([5.0, 5.0, -5.0, -5.0]), np.array([True, True, False, False])
    assert plain_risk(g, good, 0.9)[1] < 0 < plain_risk(-g, good, 0.1)[1]


def test_prior_of_separable_and_mixed_scores():
    good = np.array([90, 10, 0, 0]) * 100
    web = 0.6 * good + 0.4 * np.array([0, 0, 50, 50]) * 100
    assert quality.prior(good, web.astype(int), 0.1) == pytest.approx(0.6, abs=0.02)
    assert quality.prior(good, good, 0.1) == pytest.approx(0.99, abs=0.01)
    assert quality.prior(good * 0, good, 0.1) == 0.5


def test_features_of_odd_texts():
    for text in (None, "", " \n\t", "a", "|", "ä" * 5, "\ud800x", "word " * 50_000, "a\n" * 1000):
        at, value = quality.features(text, Hashes(), 18)
        assert len(at) == len(value) and np.isfinite(value).all() and (0 <= at).all() and (at < 1 << 18).all()
    assert [list(x) for x in quality.features(None, Hashes(), 18)] == [list(x) for x in quality.features("", Hashes(), 18)]


def corpus(spark, n=600):
    rows = [(i, f"The {i} fox runs, and the dog sleeps in house {i % 17}. It was late." if i % 3 else f"buy ### {i} $$$ now | now | now ***", i % 3 > 0) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, fine boolean")


def test_learns_from_trusted_texts_alone(spark):
    docs = corpus(spark)
    labels = docs.where("fine and doc_id % 2 = 0").select("doc_id", F.lit(1).alias("quality"))
    model = quality.fit(docs, labels, quality.Settings(batch=32))
    assert 0.5 < model.prior < 0.85
    got = {r["doc_id"]: r for r in quality.score(docs, model).collect()}
    assert sum(got[i]["predicted"] == (i % 3 > 0) for i in range(600)) >= 590
    again = quality.fit(docs.repartition(7), labels.repartition(3), quality.Settings(batch=32))
    assert np.array_equal(model.weights, again.weights)


def test_untrusted_and_missing(spark):
    docs = corpus(spark, 30).withColumns({"score": F.lit("x"), "h": F.lit(1), "at": F.lit(None).cast("string"), "good": F.lit(0)})
    docs = docs.unionByName(docs.limit(2)).unionByName(docs.limit(1).withColumns({"doc_id": F.lit(None).cast("long"), "text": F.lit(None).cast("string")}))
    torn = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None)], "doc_id long, quality int")
    for labels in (torn, torn.limit(0)):
        model = quality.fit(docs, labels)  # nobody is trusted
        rows = quality.score(docs, model).collect()
        assert len(rows) == 33 and {r["score"] for r in rows} == {0.5} and {r["predicted"] for r in rows} == {1}
    assert quality.fit(docs.limit(0), torn).prior is None
    assert quality.score(docs.limit(0), model).count() == 0
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 1)], "doc_id long, quality int")
    rows = quality.score(docs, quality.fit(docs, labels)).collect()
    assert len(rows) == 33 and all(0 <= r["score"] <= 1 for r in rows)
