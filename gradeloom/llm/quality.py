"""Text quality by positive-unlabelled learning.

Trusted good texts are the positives; the rest of what is learnt from is web text of unknown quality, good
and bad. With pi as the share of good texts among all, a classifier g has the risk

    pi * E_good[loss(g)] + max(0, E_web[loss(-g)] - pi * E_good[loss(-g)]),

whose second term stands for the unknown bad texts and is never below zero in truth. Where it falls below
zero on a mini-batch, the classifier has begun to learn single texts by heart, and the step goes back up on
that term instead. pi is estimated first, from how two halves of the sample are told apart: the share of web text
above a score over that of good text above it is an upper bound of pi, least where nearly all is good.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.llm.shared import keep
from gradeloom.llm.words import Hashes, mixed, plain_words, sequences

#: Letters, capitals and digits become one sign each, ASCII white space a space; other signs stay.
SHAPE = bytes(
    97 if c > 127 or chr(c).islower() else 65 if chr(c).isupper() else 48 if chr(c).isdigit() else 32 if chr(c).isspace() else c
    for c in range(256)
)
RUN = re.compile(rb"(.)\1+", re.S)
STEPS = 32  # of the scale of a figure
NORMS = (2.0, 1.0, 1.0, 0.5)  # of figures, shapes, pairs of shapes, words
CHUNK = 4096  # coordinates in a row of a shard's state
BINS = 1000  # of scores, where pi is estimated
STATE = "chunk int, w array<float>, n array<float>"


@dataclass(frozen=True)
class Settings:
    bits: int = 18  # features are hashed into 2**bits
    good: int = 10_000  # trusted texts to fit on, about
    web: int = 20_000  # texts of unknown quality to fit on, about
    shards: int = 4
    batch: int = 128  # texts of a mini-batch
    epochs: int = 10
    rate: float = 1.0
    l2: float = 1e-4
    beta: float = 0.0  # how far below zero the second term may fall
    gamma: float = 1.0  # length of the steps back
    delta: float = 0.1  # chance that the bounds of pi do not hold


def figures(data: bytes, words: list[bytes], shapes: list[bytes]) -> list[float]:
    """Figures of a text, each between 0 and 1."""
    n, tokens, lines = max(1, len(data)), data.split(), [x for x in data.split(b"\n") if x.strip()]
    m, counts = max(1, len(tokens)), np.bincount(np.frombuffer(data.translate(SHAPE), np.uint8), minlength=256)
    symbols = n - counts[97] - counts[65] - counts[48] - counts[32]
    ends = sum(x.rstrip()[-1:] in (b".", b"!", b"?", b":") for x in lines)
    return [
        min(1.0, math.log2(1 + len(words)) / 16),
        min(1.0, 4 * symbols / n),
        min(1.0, 4 * counts[65] / n),
        min(1.0, 4 * counts[48] / n),
        counts[32] / n,
        min(1.0, sum(map(len, words)) / max(1, len(words)) / 16),
        len(set(words)) / max(1, len(words)),
        len(set(shapes)) / max(1, len(shapes)),
        len(set(lines)) / max(1, len(lines)),
        ends / max(1, len(lines)),
        sum(map(bytes.__eq__, tokens, tokens[1:])) / m,  # said twice in a row
        max(Counter(tokens).values(), default=0) / m,
        sum(len(x) == 1 or not x[:1].isalnum() and x[0] < 128 for x in tokens) / m,
    ]


def features(text: str | None, hashes: Hashes, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of a whole text and their values: its figures, each as the steps of a scale that it
    reaches; shapes of tokens and pairs of them; words. The values of a group have a norm of its weight."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words, shapes = plain_words(text), RUN.sub(rb"\1", data.translate(SHAPE)).split()
    steps = [np.arange(1 + int(STEPS * x)) + i * (STEPS + 1) for i, x in enumerate(figures(data, words, shapes))]
    h, w = hashes.of(shapes), hashes.of(words)
    groups = [mixed(np.concatenate(steps).astype(np.uint64) + np.uint64(1)), sequences(h, [0]) + np.uint64(2), sequences(h, [0, 1]) + np.uint64(3), sequences(w, [0]) + np.uint64(4)]
    at = [np.unique(mixed(g) >> np.uint64(64 - bits)) for g in groups]
    value = [np.full(len(a), norm / math.sqrt(max(1, len(a))), np.float32) for a, norm in zip(at, NORMS)]
    return np.concatenate(at).astype(np.int32), np.concatenate(value)


def log_loss_slope(g: np.ndarray, label: float) -> np.ndarray:
    """Slope over g of log(1 + exp(-label * g))."""
    return -label / (1 + np.exp(np.clip(label * g, -35, 35)))


def risk_slopes(g: np.ndarray, good: np.ndarray, pi: float, beta: float, gamma: float) -> np.ndarray:
    """Slope of the non-negative risk of a mini-batch over each of its margins g. Without `pi` web text
    counts as bad, which tells good text from web text."""
    out = np.zeros(len(g))
    p, u = max(1, good.sum()), max(1, (~good).sum())
    if pi is None:
        out[good], out[~good] = log_loss_slope(g[good], 1.0) / p, log_loss_slope(g[~good], -1.0) / u
        return out
    loss = np.logaddexp(0, g)  # of taking a text as bad
    bad = loss[~good].sum() / u - pi * loss[good].sum() / p
    slope = np.where(good, -pi / p, 1 / u) * log_loss_slope(g, -1.0)  # of that term
    if bad < -beta:
        return -gamma * slope
    out[good] = pi / p * log_loss_slope(g[good], 1.0)
    return out + slope


class State:
    """Weights w and sums n of squared slopes by coordinate; the last coordinate is the bias."""

    def __init__(self, w: np.ndarray, n: np.ndarray, s: Settings, pi: float | None):
        self.w, self.n, self.s, self.pi = w.astype(np.float64), n.astype(np.float64), s, pi

    def learn(self, at: list[np.ndarray], value: list[np.ndarray], good: np.ndarray) -> None:
        """A step on one mini-batch, with a rate of its own for every coordinate."""
        bias = len(self.w) - 1
        index = np.concatenate([np.append(a, bias) for a in at])
        x = np.concatenate([np.append(v, 1.0) for v in value])
        row = np.repeat(np.arange(len(at)), [len(a) + 1 for a in at])
        margins = np.bincount(row, self.w[index] * x, minlength=len(at))
        slopes = risk_slopes(margins, good, self.pi, self.s.beta, self.s.gamma)
        used, where = np.unique(index, return_inverse=True)
        total = np.bincount(where, slopes[row] * x) + self.s.l2 * self.w[used]
        self.n[used] += total * total
        self.w[used] -= self.s.rate * total / np.sqrt(self.n[used] + 1e-12)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # 2**bits, and the bias
    bits: int
    prior: float | None

    def score(self, text: str | None, hashes: Hashes) -> float:
        at, value = features(text, hashes, self.bits)
        total = float((self.weights[at] * value).sum() + self.weights[-1])
        return 1 / (1 + math.exp(-min(35.0, max(-35.0, total))))


def sample(df: DataFrame, labels: DataFrame, s: Settings, key: str, text: str, label: str) -> DataFrame:
    """h, good and the features of about `s.good` trusted texts and `s.web` texts of unknown quality, those
    whose keys have the least hashes. Trusted is a key of which no label says other than 1; it can be among
    the web texts as well. Rows without a key are left out."""
    trusted = labels.select(F.col(key).alias("k"), F.col(label).cast("int").alias("y")).dropna()
    trusted = trusted.groupBy("k").agg(F.min("y").alias("lo"), F.max("y").alias("hi")).where("lo = 1 and hi = 1").select("k", F.xxhash64("k").alias("h"))
    rows = df.where(F.col(key).isNotNull()).select(F.col(key).alias("k"), F.col(text).alias("text"))
    web = rows.withColumn("h", F.xxhash64(F.lit("web"), "k"))

    def some(of: DataFrame, most: int) -> DataFrame:
        n = of.count()
        return of if n <= most else of.where(F.col("h") < int(-(2**63) + 2**64 * most / n))

    good = rows.join(F.broadcast(some(trusted, s.good)), "k")  # about `s.good` keys go to the documents
    both = good.select("h", "text", F.lit(True).alias("good")).union(some(web, s.web).select("h", "text", F.lit(False)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = Hashes()
        for batch in batches:
            at, x = zip(*(features(t, hashes, s.bits) for t in batch["text"])) if len(batch) else ((), ())
            yield pd.DataFrame({"h": batch["h"], "good": batch["good"], "at": at, "x": x})

    return both.mapInPandas(run, "h long, good boolean, at array<int>, x array<float>")


def _epoch(rows: DataFrame, held, s: Settings, pi: float | None) -> DataFrame:
    """The state of each shard after a pass over its rows, which come in the order of their hashes."""

    def written(state: State) -> pa.RecordBatch:
        cuts = range(0, len(state.w), CHUNK)
        cols = [pa.array([x[c : c + CHUNK].astype(np.float32) for c in cuts], pa.list_(pa.float32())) for x in (state.w, state.n)]
        return pa.RecordBatch.from_arrays([pa.array(range(len(cuts)), pa.int32()), *cols], names=["chunk", "w", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, state, waiting = None, None, []

        def step() -> None:
            if waiting:
                state.learn([a for a, _, _ in waiting], [x for _, x, _ in waiting], np.array([g for _, _, g in waiting]))
                waiting.clear()

        for batch in batches:
            lists = [(c.value_lengths().to_numpy().cumsum()[:-1], c.flatten().to_numpy()) for c in (batch.column("at"), batch.column("x"))] if batch.num_rows else []
            rows = zip(batch.column("shard").to_pylist(), *(np.split(flat, cuts) for cuts, flat in lists), batch.column("good").to_pylist()) if lists else ()
            for of, at, x, good in rows:
                if of != shard:
                    step()
                    if state is not None:
                        yield written(state)
                    shard, state = of, State(*held.value, s, pi)
                waiting.append((at, x, good))
                if len(waiting) == s.batch:
                    step()
        step()
        if state is not None:
            yield written(state)

    return rows.select("shard", "good", "at", "x").mapInArrow(run, STATE)


def _trained(rows: DataFrame, s: Settings, pi: float | None) -> np.ndarray:
    """Weights after `s.epochs` passes of all shards from a common state, averaged after every pass."""
    context, size = rows.sparkSession.sparkContext, (1 << s.bits) + 1

    def mean(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        row = {c: [np.mean(np.stack(parts[c].to_list()), axis=0)] for c in ("w", "n")}
        return pd.DataFrame({"chunk": [key[0]], **row})

    w, n = np.zeros(size, np.float32), np.zeros(size, np.float32)
    for _ in range(s.epochs):
        held = context.broadcast((w, n))  # 2**bits coordinates
        parts = sorted(_epoch(rows, held, s, pi).groupBy("chunk").applyInPandas(mean, STATE).collect(), key=lambda r: r["chunk"])
        held.unpersist()
        if not parts:
            break
        w, n = (np.concatenate([np.array(r[c], dtype=np.float32) for r in parts]) for c in ("w", "n"))
    return w


def prior(good: np.ndarray, web: np.ndarray, delta: float) -> float:
    """pi from the numbers of good and of web texts by score, best first.

    Of all cuts the one with the least upper confidence bound on (share of web text above it) / (share of
    good text above it) is taken, and that ratio is the estimate."""
    p, u = good.sum(), web.sum()
    if not p or not u:
        return 0.5
    above_p, above_u = np.cumsum(good) / p, np.cumsum(web) / u
    some = above_p > 0
    above_p, above_u = above_p[some], above_u[some]
    loose = math.sqrt(math.log(4 / delta) / 2 / u) + math.sqrt(math.log(4 / delta) / 2 / p)
    best = np.argmin((above_u + loose) / above_p)
    return float(np.clip(above_u[best] / above_p[best], 0.01, 0.99))


def fit(df: DataFrame, labels: DataFrame, s: Settings = Settings(), key="doc_id", text="text", label="quality") -> Model:
    """A model of `label` = 1 by `text`, from keys that `labels` trusts and the texts of `df` alone.

    Rows that are not to be learnt from must be in neither table. Labels other than 1 are not used, but that
    they make a key untrusted. Without trusted rows, or without texts, every score is 0.5. Null texts
    are empty texts.
    """
    # Shards follow from hashes of the keys, and each is written in one piece and order, so that passes,
    # retries and other layouts of the tables all learn the same.
    rows = keep(sample(df, labels, s, key, text, label))
    rows = rows.withColumns({"shard": F.pmod(F.xxhash64("h"), F.lit(s.shards)).cast("int"), "turn": F.xxhash64("h", "good")})
    rows = rows.withColumn("fold", F.shiftrightunsigned("turn", 7).bitwiseAND(F.lit(1)).cast("int"))
    rows = keep(rows.repartitionByRange(s.shards, "shard").sortWithinPartitions("shard", "turn", "at", "good"))
    found = {r["good"]: r["n"] for r in rows.groupBy("good").agg(F.count("*").alias("n")).collect()}
    size = (1 << s.bits) + 1
    if len(found) < 2:
        return Model(np.zeros(size, np.float32), s.bits, None)

    # Half of the sample learns to tell good from web text, the other half estimates pi.
    apart = Model(_trained(rows.where("fold = 0"), replace(s, epochs=max(1, s.epochs // 2)), None), s.bits, None)
    held = df.sparkSession.sparkContext.broadcast(apart.weights)

    @F.pandas_udf("int")
    def bin_of(at: pd.Series, x: pd.Series) -> pd.Series:
        margins = np.array([(held.value[a] * v).sum() for a, v in zip(at, x)]) + held.value[-1]
        return pd.Series((BINS / (1 + np.exp(np.clip(margins, -35, 35)))).astype(int).clip(max=BINS - 1))  # best first

    counts = rows.where("fold = 1").groupBy(bin_of("at", "x").alias("bin"), "good").agg(F.count("*").alias("n")).collect()
    by_bin = np.zeros((2, BINS), dtype=np.int64)
    for r in counts:
        by_bin[int(r["good"]), r["bin"]] = r["n"]
    pi = prior(by_bin[1], by_bin[0], s.delta)
    return Model(_trained(rows, s, pi), s.bits, pi)


def score(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score (0 to 1, higher: better) and predicted (score of 0.5 or more) for each row; whole texts,
    no shuffle. Null texts are scored as empty ones; repeated rows get the same score."""
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
