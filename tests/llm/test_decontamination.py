import random

from pyspark.sql import functions as F

from gradeloom.llm import decontamination as D
from gradeloom.llm.words import plain_words


def brute(docs, items, size=5, threshold=0.8):
    wants = [(i, words, set(D.shingles(words, size))) for i, words in ((i, plain_words(t)) for i, t in items)]
    out = set()
    for d, text in docs:
        words = plain_words(text)
        held = {n: {b" ".join(words[p : p + n]) for p in range(len(words) - n + 1)} for n in range(1, size + 1)}
        for i, item, want in wants:
            shared = len(want & held[min(size, len(item))]) if want else 0
            if want and shared / len(want) >= threshold:
                out.add((d, i, len(want), shared))
    return out


def test_against_brute_force(spark, monkeypatch):
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(400)] + ["Das", "É"]
    say = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    items = [(i, say(rnd.choice([1, 4, 5, 6, 9, 30, 80]))) for i in range(60)] + [(60, None), (61, ""), (62, "!!"), (7, "w1 w2 w3 w4 w5 w6")]
    docs = [(i, say(rnd.choice([0, 3, 50, 900]))) for i in range(150)] + [(150, None), (151, "")]
    for i in range(120):  # items whole, cut, in pieces far apart, in other case and with other marks
        words_of = (items[i % 60][1]).split()
        keep = words_of[: max(1, round(len(words_of) * rnd.choice([1, 0.95, 0.85, 0.7])))]
        half = len(keep) // 2
        inner = rnd.choice([" ".join(keep), " ".join(keep[:half]) + f" {say(200)} " + " ".join(keep[half:]), ", ".join(keep).upper()])
        docs.append((200 + i, f"{say(rnd.choice([0, 40, 3000]))} {inner} {say(20)}"))
    docs += [(400, items[0][1]), (401, items[0][1]), (401, items[0][1])]
    want = brute(docs, items)
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit(0))
    t = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(0))
    for block in (D.BLOCK_SHINGLES, 300):
        monkeypatch.setattr(D, "BLOCK_SHINGLES", block)
        got = D.contained_items(d, t)
        assert {(r["doc_id"], r["item_id"], r["n_shingles"], r["n_shared"]) for r in got.collect()} == want
        kept = {r["doc_id"] for r in D.clean_documents(d, t).collect()}
        assert kept == {i for i, _ in docs} - {w[0] for w in want}
    assert D.clean_documents(d, t).columns == d.columns


def test_empty_tables(spark):
    d, t = (spark.createDataFrame([], f"{k} long, text string") for k in ("doc_id", "item_id"))
    assert D.contained_items(d, t).collect() == []
    one = spark.createDataFrame([(None, "a b c d e f")], "doc_id long, text string")
    assert D.clean_documents(one, t).count() == 1
    assert D.clean_documents(one, spark.createDataFrame([(None, "a b c d e f")], "item_id long, text string")).count() == 0


def test_short_items_in_long_documents(spark):
    d = spark.createDataFrame([(1, "the quick brown fox runs away from all the dogs"), (2, "quick brown fox"), (3, "Quick, brown"), (4, "fox runs")], "doc_id long, text string")
    t = spark.createDataFrame([(1, "quick brown fox runs"), (2, "quick brown"), (3, "quick brown"), (4, "fox fox"), (5, "quick brown fox runs away")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in D.contained_items(d, t).collect()}
    assert got == {(1, 1), (1, 2), (1, 3), (1, 5), (2, 2), (2, 3), (3, 2), (3, 3)}
    assert [r["doc_id"] for r in D.clean_documents(d, t).collect()] == [4]
