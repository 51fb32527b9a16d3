"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Follow-the-regularised-leader keeps two numbers per coordinate, z and n; the weight, its learning
rate and its L1 threshold follow from them, so coordinates without evidence have weight zero and the
fitted model is a short list of weights. The labelled sample is split into shards; in each epoch every
shard runs FTRL over its rows from the common state, and the states are averaged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.llm.shared import keep
from gradeloom.llm.words import Hashes, plain_words, sequences

#: Words at these distances form a feature: single words, pairs, triples, and pairs with one or two words skipped.
GRAMS = ([0], [0, 1], [0, 1, 2], [0, 2], [0, 3])
CHUNK = 4096  # coordinates in a row of a shard's state


@dataclass(frozen=True)
class Settings:
    bits: int = 20  # features are hashed into 2**bits
    sample: int = 20_000  # labelled rows to fit on, about
    shards: int = 4
    epochs: int = 5
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 3.0
    l2: float = 0.01


def features(text: str | None, hashes: Hashes, bits: int) -> np.ndarray:
    """The different hashed features of a text, in order."""
    h = hashes.of(plain_words(text))
    parts = [sequences(h, g) + np.uint64(i) for i, g in enumerate(GRAMS) if len(h) > max(g)]
    if not parts:
        return np.empty(0, np.int64)
    return np.unique((np.concatenate(parts) >> np.uint64(64 - bits)).astype(np.int64))


class State:
    """z and n of FTRL by coordinate; the last one is the bias."""

    def __init__(self, z: np.ndarray, n: np.ndarray, s: Settings):
        self.z, self.n, self.s = z.copy(), n.copy(), s

    def weights(self, at) -> np.ndarray:
        z, s = self.z[at], self.s
        shrunk = np.sign(z) * s.l1 - z
        return np.where(np.abs(z) <= s.l1, 0.0, shrunk / ((s.beta + np.sqrt(self.n[at])) / s.alpha + s.l2))

    def learn(self, at: np.ndarray, label: float) -> None:
        w = self.weights(at)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        root = np.sqrt(self.n[at])
        self.n[at] += g * g
        self.z[at] += g - (np.sqrt(self.n[at]) - root) / self.s.alpha * w


@dataclass(frozen=True)
class Model:
    """Weights other than zero, by hashed feature."""

    index: np.ndarray
    weight: np.ndarray
    bias: float
    bits: int

    def score(self, text: str | None, hashes: Hashes) -> float:
        total = self.bias
        if len(self.index):
            at = features(text, hashes, self.bits)
            place = np.searchsorted(self.index, at).clip(max=len(self.index) - 1)
            total += float(self.weight[place][self.index[place] == at].sum())
        return float(1 / (1 + np.exp(-np.clip(total, -35, 35))))


def labelled_sample(df: DataFrame, labels: DataFrame, s: Settings, key: str, text: str, label: str) -> DataFrame:
    """Rows h, text, label of about `s.sample` labelled keys, those with the least hashes.

    A key with several labels counts as 1 if any of them is. Null keys and labels are left out. The
    keys are few by the bound, so they go to the documents, whose texts stay where they are.
    """
    pairs = labels.select(F.col(key).alias("k"), F.col(label).cast("int").alias("label")).dropna()
    pairs = pairs.groupBy("k").agg(F.max("label").alias("label")).withColumn("h", F.xxhash64("k"))
    total = pairs.count()
    if total > s.sample:
        pairs = pairs.where(F.col("h") < int(-(2**63) + 2**64 * s.sample / total))
    rows = df.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.join(F.broadcast(pairs), "k").select("h", "text", "label")


def fit(df: DataFrame, labels: DataFrame, s: Settings = Settings(), key="doc_id", text="text", label="toxic") -> Model:
    """A model of `label` (0 or 1) by `text`. `labels` has one row per labelled key; rows to leave
    out of learning must not be in it. Without labelled rows, or with one class alone, the model
    gives 0.5, or nearly the class that there is. Null texts are empty texts.
    """
    spark, state = df.sparkSession, "chunk int, z array<float>, n array<float>"
    # Shards follow from the keys, and each is written in one piece and order, so that epochs, retries and
    # other layouts of the table all learn the same.
    sample = labelled_sample(df, labels, s, key, text, label).withColumn("shard", F.pmod("h", F.lit(s.shards)))
    sample = sample.repartition(s.shards, "shard").sortWithinPartitions("shard", "h", "text", "label")
    sample = keep(sample).coalesce(s.shards)
    bias = 1 << s.bits
    z, n = np.zeros(bias + 1), np.zeros(bias + 1)
    for _ in range(s.epochs):
        held = spark.sparkContext.broadcast((z.astype(np.float32), n.astype(np.float32)))  # 2**bits coordinates

        def written(state: State) -> pd.DataFrame:
            cuts = range(0, bias + 1, CHUNK)
            parts = {c: [x[i : i + CHUNK].astype(np.float32) for i in cuts] for c, x in (("z", state.z), ("n", state.n))}
            return pd.DataFrame({"chunk": list(range(len(cuts))), **parts})

        def run(batches: Iterator[pd.DataFrame], held=held) -> Iterator[pd.DataFrame]:
            hashes, at, state = Hashes(), None, None
            for batch in batches:
                for shard, value, y in zip(batch["shard"], batch["text"], batch["label"]):
                    if shard != at:
                        if state is not None:
                            yield written(state)
                        at, state = shard, State(*(x.astype(np.float64) for x in held.value), s)
                    state.learn(np.append(features(value, hashes, s.bits), bias), float(y > 0))
            if state is not None:
                yield written(state)

        def mean(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
            row = {c: [np.mean(np.stack(parts[c].to_list()), axis=0)] for c in ("z", "n")}
            return pd.DataFrame({"chunk": [key[0]], **row})

        merged = sample.mapInPandas(run, state).groupBy("chunk").applyInPandas(mean, state)
        parts = sorted(merged.collect(), key=lambda r: r["chunk"])
        held.unpersist()
        if not parts:
            break
        z, n = (np.concatenate([np.array(r[c]) for r in parts]) for c in ("z", "n"))
    weights = State(z, n, s).weights(slice(None))
    some = np.flatnonzero(weights[:-1])
    return Model(some, weights[some], float(weights[-1]), s.bits)


def score(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score (0 to 1) and predicted (score of 0.5 or more) for each row, whole texts, no
    shuffle. Empty and null texts get the score of the bias."""
    kind = df.schema[key].dataType.simpleString()
    held = df.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = Hashes()
        for batch in batches:
            scores = np.array([held.value.score(t, hashes) for t in batch["text"]], dtype=float)
            out = pd.DataFrame({"score": scores, "predicted": (scores >= 0.5).astype("int32")})
            out.insert(0, "doc_id", batch["doc_id"].array)
            yield out

    source = df.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    return source.mapInPandas(judge, f"doc_id {kind}, score double, predicted int")
