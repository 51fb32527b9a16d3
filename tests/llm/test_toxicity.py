import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gradeloom.llm import toxicity as X
from gradeloom.llm.words import Hashes, plain_words


def test_features_are_the_hashed_grams():
    hashes, words = Hashes(), plain_words("A b, c d b")
    assert words == [b"a", b"b", b"c", b"d", b"b"]
    few = X.features("A b, c d b", hashes, 20)
    assert len(few) == len(set(few)) and (np.diff(few) > 0).all()
    assert len(few) == 4 + 4 + 3 + 3 + 2
    assert len(X.features(None, hashes, 20)) == len(X.features(" !", hashes, 20)) == 0
    assert set(X.features("a b", hashes, 20)) <= set(few)


def plain_ftrl(rows, size, s):
    z, n = [0.0] * size, [0.0] * size
    weight = lambda i: 0.0 if abs(z[i]) <= s.l1 else -(z[i] - np.sign(z[i]) * s.l1) / ((s.beta + n[i] ** 0.5) / s.alpha + s.l2)
    for at, y in rows:
        w = {i: weight(i) for i in at}
        g = 1 / (1 + np.exp(-sum(w.values()))) - y
        for i in at:
            z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / s.alpha * w[i]
            n[i] += g * g
    return [weight(i) for i in range(size)]


def test_state_follows_the_published_update():
    rng, s = np.random.default_rng(1), X.Settings()
    rows = [(np.unique(rng.integers(0, 12, 5)), float(rng.integers(0, 2))) for _ in range(300)]
    state = X.State(np.zeros(12), np.zeros(12), s)
    for at, y in rows:
        state.learn(at, y)
    assert np.allclose(state.weights(slice(None)), plain_ftrl(rows, 12, s))


@pytest.fixture(scope="module")
def tables(spark):
    rnd = random.Random(4)
    say = lambda n: [f"w{rnd.randint(0, 3000)}" for _ in range(n)]
    rows, labels = [], []
    for i in range(900):
        words, toxic = say(rnd.randint(5, 80)), i % 5 == 0
        if toxic:
            words[rnd.randrange(len(words))] = rnd.choice(["nasty", "vile", "awful"])
        rows.append((i, " ".join(words), 1.5))
        labels.append((i, int(toxic), "x"))
    rows += [(2000, None, 0.0), (2001, "", 0.0), (None, "vile vile", 0.0), (2002, "w1 " * 50_000 + "nasty", 0.0), (2002, "w1", 0.0)]
    labels += [(None, 1, "x"), (5, None, "x"), (0, 0, "x"), (1, 1, "x"), (1, 1, "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, score double"), spark.createDataFrame(labels, "doc_id long, toxic int, text string")


def test_held_out(spark, tables):
    docs, labels = tables
    model = X.fit(docs, labels.where("doc_id % 3 != 0"))
    got = {r["doc_id"]: r for r in X.score(docs, model).where("doc_id < 900").collect()}
    held = [i for i in range(900) if i % 3 == 0]
    right = sum(got[i]["predicted"] == int(i % 5 == 0) for i in held)
    assert right >= 0.97 * len(held)
    everything = X.score(docs, model)
    assert everything.count() == docs.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in everything.collect())
    empty = {r["score"] for r in everything.where("doc_id in (2000, 2001)").collect()}
    assert len(empty) == 1 and len(model.index) < 1000  # of 20,000 different features and more
    again = X.fit(docs.repartition(5), labels.where("doc_id % 3 != 0").repartition(3))
    assert np.array_equal(model.index, again.index) and np.allclose(model.weight, again.weight, atol=1e-6)


def test_nothing_to_learn_from(spark, tables):
    docs, labels = tables
    model = X.fit(docs, labels.limit(0))
    assert {r["score"] for r in X.score(docs, model).collect()} == {0.5}
    assert X.score(docs.limit(0), model).collect() == []
    one = X.fit(docs, labels.where(F.col("toxic") == 0), X.Settings(epochs=1))
    assert {r["predicted"] for r in X.score(docs, one).collect()} == {0}
