"""Rewards on the listed cases and on random text, against a plain restatement in Python."""

import random
import re

import pytest
from pyspark.sql import functions as F

from gradeloom.functions import rewards as R
from gradeloom.functions.text import SPACE, SPACES, strip
from gradeloom.operators.scoring import score_completions, score_routed, score_samples

# The patterns that grading has to agree with.
NUMBER = r"-?\d[\d,]*\.?\d*"
BOX = r"\\boxed\{([^}]*)\}"
HASH = r"####\s*(.+?)\s*$"


def number_of(text):
    found = re.findall(NUMBER, text)
    if not found:
        return None
    whole, _, fraction = found[0].replace(",", "").partition(".")
    return whole if fraction in ("", "0") else f"{whole}.{fraction}"


def answer_of(text):
    places = re.findall(BOX, text)[:1] + re.findall(HASH, text, re.M)[:1] + [text.split("\n")[-1], text]
    return next((n for n in map(number_of, places) if n is not None), None)


def formed(text):
    return bool(re.findall(BOX, text) or re.findall(HASH, text, re.M))


def graded(spark, pairs):
    df = spark.createDataFrame(pairs, "completion string, gold string")
    text, gold = F.col("completion"), F.col("gold")
    return df.select(
        R.predicted_answer(text).alias("predicted"),
        R.normalize_number(gold).alias("gold"),
        R.correctness_reward(text, gold).alias("correct"),
        R.format_reward(text).alias("format"),
        R.gsm8k_score(text, gold).alias("score"),
        R.extract_gold(text).alias("as_gold"),
        strip(text).alias("stripped"),
    ).collect()


CASES = [
    # completion, gold, prediction, correctness, format
    ("reasoning... #### 4", "4", "4", 1.0, 0.1),
    ("the answer is \\boxed{5}", "4", "5", 0.0, 0.1),
    ("just 4 somewhere", "4", "4", 1.0, 0.0),
    ("a\n3 then 7", "7", "3", 0.0, 0.0),
    ("9 apples\n", "9", "9", 1.0, 0.0),
    ("#### 1\n#### 2", "2", "1", 0.0, 0.1),
    ("####\n18", "18", "18", 1.0, 0.1),
    ("\\boxed{} #### 6", "6", "6", 1.0, 0.1),
    ("#### 5.00", "5", "5.00", 0.0, 0.1),
    ("####   ", "5", None, 0.0, 0.1),
    ("####", "5", None, 0.0, 0.0),
    ("12.0.", "12", "12", 1.0, 0.0),
    ("$1,000", "1000", "1000", 1.0, 0.0),
    ("10-5", "10", "10", 1.0, 0.0),
    ("-0", "0", "-0", 0.0, 0.0),
    ("007", "7", "007", 0.0, 0.0),
    ("none", "none", None, 0.0, 0.0),
    ("", "1", None, 0.0, 0.0),
]


def test_listed_cases(spark):
    for (text, _, predicted, correct, form), row in zip(CASES, graded(spark, [c[:2] for c in CASES])):
        assert (row["predicted"], row["correct"], row["format"]) == (predicted, correct, form), text
        assert row["score"] == pytest.approx(correct + form)


def test_gold_uses_the_last_marker(spark):
    rows = graded(spark, [("#### 1\n#### 2,0 ", ""), ("no mark 1,2 ", ""), ("a #####4", "")])
    assert [r["as_gold"] for r in rows] == ["20", "no mark 12", "#4"]


def random_texts(n, alphabet, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 14))) for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_random_texts_agree_with_python(spark, seed):
    # Separators and digits of other scripts, and every line end that only some engines know.
    alphabet = ["#", "####", "#### ", "\\boxed{", "}", "0", "1", "7", ",", ".", "-", " ", "\n", "\t", "\r", "x",
                "\x1c", "\x1f", "\x85", "\u2028", "\u00a0", "\u0663", "\u3000", "\u00e9"]
    texts = random_texts(8000, alphabet, seed)
    golds = random_texts(8000, alphabet, seed + 100)
    for text, gold, row in zip(texts, golds, graded(spark, list(zip(texts, golds)))):
        assert row["predicted"] == answer_of(text), repr(text)
        assert row["gold"] == number_of(gold), repr(gold)
        same = answer_of(text) is not None and answer_of(text) == number_of(gold)
        assert row["correct"] == (1.0 if same else 0.0)
        assert row["format"] == (0.1 if formed(text) else 0.0), repr(text)
        assert row["as_gold"] == text.split("####")[-1].strip().replace(",", ""), repr(text)
        assert row["stripped"] == text.strip(), repr(text)


def test_whitespace_is_what_python_takes_for_it(spark):
    blank = {c for c in map(chr, range(0x110000)) if c.isspace()}
    assert set(SPACES) == blank
    letters = [(chr(c),) for c in range(0x3100)]
    matched = spark.createDataFrame(letters, "c string").where(F.col("c").rlike(f"^{SPACE}\\z")).collect()
    assert {r["c"] for r in matched} == blank


def test_strip_is_linear_in_blank_runs(spark):
    text = "a" + " " * 200_000 + "b" + " " * 10
    got = spark.createDataFrame([(text,)], "t string").select(strip(F.col("t"))).first()[0]
    assert got == text.rstrip()


def test_long_blank_runs_are_graded_in_passing(spark):
    text = "#### " + "a" + " " * 100_000 + "b 7"
    assert graded(spark, [(text, "7")])[0]["score"] == pytest.approx(1.1)


def test_components_sum_to_the_scalar(spark):
    df = spark.createDataFrame([c[:2] for c in CASES], "completion string, answer string")
    rows = score_completions(df, "gsm8k").withColumn("scalar", R.gsm8k_score(F.col("completion"), F.col("answer")))
    for row in rows.collect():
        assert row["reward_total"] == row["scalar"] == row["correctness"] + row["format"]


def test_message_completions_use_the_last_one(spark):
    chat = [("assistant", "#### 9"), ("assistant", "#### 4")]
    df = spark.createDataFrame([(chat, "4")], "completion array<struct<role:string,content:string>>, answer string")
    assert score_completions(df, "gsm8k").first()["reward_total"] == pytest.approx(1.1)


def test_routing(spark):
    df = spark.createDataFrame(
        [("gsm8k", "#### 4", "4"), ("nope", "x", "1"), (None, "x", "1")],
        "data_source string, solution_str string, ground_truth string",
    )
    rows = score_routed(df, fail=False).collect()
    assert [r["score"] for r in rows] == [1.1, None, None]
    assert [r["reject_reason"] for r in rows] == [
        None,
        "no reward scorer for data_source: nope",
        "no reward scorer for data_source: null",
    ]
    with pytest.raises(Exception, match="no reward scorer for data_source"):
        score_routed(df).select("score").collect()
    assert score_routed(df.where("data_source = 'gsm8k'")).first()["score"] == pytest.approx(1.1)


def test_samples(spark):
    schema = "response string, label string, metadata struct<data_source:string>"
    good = spark.createDataFrame([("a #### 4", "4", ("gsm8k",))], schema)
    assert score_samples(good).first()["score"] == pytest.approx(1.1)
    bad = spark.createDataFrame([("x", "1", None)], schema)
    with pytest.raises(Exception, match="data_source: null"):
        score_samples(bad).collect()
    assert score_samples(bad, fail=False).first()["score"] is None


def test_rubric_and_rollout_text(spark):
    turns = "array<struct<role:string,content:string>>"
    df = spark.createDataFrame([([("a", "x"), ("b", "#### 4")], "4"), ([], "4"), ([("a", None)], "4"), (None, "4")],
                               f"turns {turns}, gold string")
    text = R.rollout_text(F.col("turns"))
    total = R.weighted_rubric([(1.0, R.gsm8k_score(text, F.col("gold"))), (2.0, R.format_reward(text))])
    assert [r[0] for r in df.select(text).collect()] == ["#### 4", "", "", ""]
    assert [r[0] for r in df.select(total).collect()] == [pytest.approx(1.3), 0.0, 0.0, 0.0]


def test_own_scorer(spark, monkeypatch):
    import pandas as pd

    monkeypatch.setattr(R, "_SCORERS", dict(R._SCORERS))

    @F.pandas_udf("double")
    def long_enough(text: pd.Series) -> pd.Series:
        return (text.str.len() > 3).astype("float64")

    R.register_scorer("length", {"long": lambda text, gold: long_enough(text), "fixed": lambda text, gold: F.lit(2.0)})
    df = spark.createDataFrame([("length", "abcd", "x"), ("gsm8k", "#### 4", "4")],
                               "data_source string, completion string, answer string")
    assert [r["reward_total"] for r in score_completions(df, "length").collect()] == [3.0, 3.0]
    routed = score_routed(df, solution="completion", gold="answer")
    assert [r["score"] for r in routed.collect()] == [3.0, pytest.approx(1.1)]
    for bad in (lambda: R.reward_components("nope"), lambda: R.register_scorer("none", {}), lambda: R.weighted_rubric([])):
        with pytest.raises(ValueError):
            bad()


def test_shaping(spark):
    df = spark.createDataFrame([(1.0, True, 0.5), (1.0, False, 0.0)], "r double, eos boolean, kl double")
    got = df.select(R.missing_eos_penalty(F.col("r"), F.col("eos"), 2.0), R.kl_shaped_reward(F.col("r"), F.col("kl"), 0.1))
    assert [tuple(r) for r in got.collect()] == [(1.0, 0.95), (-1.0, 1.0)]


def test_a_completion_without_messages_goes_to_the_rejects(spark):
    kind = "array<struct<role:string,content:string>>"
    rows = [([("assistant", "#### 4")], "4"), ([], "4"), (None, "4")]
    df = spark.createDataFrame(rows, f"completion {kind}, answer string")
    got = score_completions(df, "gsm8k", fail=False).collect()
    assert [(r["reward_total"], r["reject_reason"]) for r in got] == [(1.1, None), (None, "empty completion"), (None, "empty completion")]
    with pytest.raises(Exception):
        score_completions(df, "gsm8k").collect()
