"""Chat text, loss spans, templates."""

import random

import pytest
from pyspark.sql import functions as F

from gradeloom.functions import chat as C
from gradeloom.schemas import SFT


def talks(n, seed=3):
    rng = random.Random(seed)
    words = ["a", "bb", "é", "日本", "\n", " ", "<think>", ""]
    say = lambda: "".join(rng.choice(words) for _ in range(rng.randint(0, 6)))
    return [
        [{"role": rng.choice(["system", "user", "assistant"]), "content": say()} for _ in range(rng.randint(1, 7))]
        for _ in range(n)
    ]


def test_chat_text_and_spans(spark):
    conversations = talks(200)
    m = F.col("messages")
    df = spark.createDataFrame([(t,) for t in conversations], SFT).select(
        C.render_chat(m).alias("text"),
        C.render_chat(m, True).alias("cued"),
        C.assistant_spans(m).alias("spans"),
        C.loss_coverage(m).alias("coverage"),
        C.chat_chars(m).alias("chars"),
    )
    for talk, row in zip(conversations, df.collect()):
        blocks = ["<|im_start|>" + t["role"] + "\n" + t["content"] + "<|im_end|>\n" for t in talk]
        assert row["text"] == "".join(blocks)
        assert row["cued"] == row["text"] + "<|im_start|>assistant\n"
        learned = [row["text"][s["start"] : s["end"]] for s in row["spans"]]
        assert learned == [t["content"] + "<|im_end|>\n" for t in talk if t["role"] == "assistant"]
        assert row["chars"] == len(row["text"])
        assert row["coverage"] == pytest.approx(sum(map(len, learned)) / len(row["text"]))


def test_mask_covers_the_answer_only(spark):
    talk = [{"role": "user", "content": "2+2?"}, {"role": "assistant", "content": "<think>add</think> 4"}]
    row = spark.createDataFrame([(talk,)], SFT).select(
        C.render_chat(F.col("messages")).alias("t"), C.assistant_spans(F.col("messages")).alias("s")
    ).first()
    masked = "".join(row["t"][s["start"] : s["end"]] for s in row["s"])
    assert "4" in masked and "2+2?" not in masked and 0 < len(masked) < len(row["t"])


def test_templates():
    assert C.resolve_chat_template("reasoning_chatml") is C.render_chat
    assert C.resolve_chat_template(None) is None and C.resolve_chat_template("") is None
    with pytest.raises(ValueError):
        C.resolve_chat_template("nope")
    C.register_template("loud", lambda m, cue=False: F.lit("!"))
    assert C.resolve_chat_template("loud") is not None


def test_user_prompt(spark):
    got = spark.range(1).select(C.render_user_prompt(F.lit("go"))).first()[0]
    assert got == "<|im_start|>user\ngo<|im_end|>\n<|im_start|>assistant\n"
