from pyspark.sql import functions as F

from gradeloom.llm.quotation import conversations, passages

SCHEMA = "message_id string, sent long, text string, list string, level string"


def talk(spark, rows, **how):
    df = spark.createDataFrame([(*r, *["x"] * (5 - len(r))) for r in rows], SCHEMA)
    return {r["message_id"]: r for r in conversations(df, **how).collect()}


def test_passages(spark):
    rows = ["a\n> b\n>c\n>> d\n > > e\nf\n", None, "", "> only", "a\n\nb", ">" * 5000 + " deep", "> x\r\n> y"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "i int, t string")
    got = {r["i"]: [(p["depth"], p["body"]) for p in r["p"]] for r in df.select("i", passages("t").alias("p")).collect()}
    assert got == {
        0: [(0, "a"), (1, "b\nc"), (2, "d\ne"), (0, "f\n")],
        1: [],
        2: [(0, "")],
        3: [(1, "only")],
        4: [(0, "a\n\nb")],
        5: [(5000, "deep")],
        6: [(1, "x\ny")],
    }


def test_replies_nested_partial_and_unknown_quotes(spark):
    got = talk(
        spark,
        [
            ("a", 1, "Hello all,\nwho knows the  answer?"),
            ("b", 2, "> hello ALL,\n> who knows the answer?\nI do."),
            ("c", 3, ">> Hello all,\n>> who knows the answer?\n> I do.\nTell us!"),
            ("d", 4, "> who knows the answer?\nMe too."),  # one line of it
            ("e", 5, "> never written\nWhat?"),
            ("f", 0, "> I do.\nToo early."),  # sent before what it quotes
            ("g", 6, None),
            ("h", 7, ""),
            ("i", None, "> I do."),
            (None, 8, "> I do."),
        ],
    )
    parents = {k: r["parent_id"] for k, r in got.items()}
    assert parents == {"a": None, "b": "a", "c": "b", "d": "a", "e": None, "f": None, "g": None, "h": None, "i": None}
    assert (got["c"]["n_quotes"], got["c"]["n_linked"], got["e"]["n_linked"]) == (2, 2, 0)
    assert [got[k]["body"] for k in "bcdgh"] == ["I do.", "Tell us!", "Me too.", "", ""]
    thread = sorted((r["place"], k) for k, r in got.items() if r["thread_id"] == "a")
    assert thread == [(0, "a"), (1, "b"), (2, "d"), (3, "c")]


def test_scope_comes_first_and_repeats_fold(spark):
    rows = [("a", 1, "same words", "l1"), ("b", 2, "same words", "l2"), ("c", 3, "> same words\nx", "l2"), ("d", 3, "> same words\nx", "l3")]
    got = talk(spark, rows + rows, scope="list")
    assert len(got) == 4 and (got["c"]["parent_id"], got["d"]["parent_id"]) == ("b", "a")
    assert talk(spark, rows)["c"]["parent_id"] == "a"


def test_an_undated_copy_hides_no_dated_original(spark):
    rows = [("a", 1, "same words", "l1"), ("u", None, "same words", "l1"), ("v", None, "same words", "l2")]
    rows += [("b", 2, "> same words\nx", "l1"), ("c", 3, "> same words\ny", "l2"), ("d", 4, "> same words\nz", "l3")]
    got = talk(spark, rows, scope="list")
    assert {k: got[k]["parent_id"] for k in "auvbcd"} == {"a": None, "u": None, "v": None, "b": "a", "c": "a", "d": "a"}
    assert [got[k]["n_linked"] for k in "bcd"] == [1, 1, 1]


def test_long_chain_and_common_message(spark):
    rows = [("m000", 0, "text 0")] + [(f"m{i:03}", i, f"> text {i - 1}\ntext {i}") for i in range(1, 70)]
    rows += [(f"r{i:03}", 100 + i, f"> text 0\nreply {i}") for i in range(300)]
    got = talk(spark, rows)
    assert {r["thread_id"] for r in got.values()} == {"m000"}
    assert got["m069"]["level"] == 69 and sorted(r["place"] for r in got.values()) == list(range(370))
    order = sorted(got.values(), key=lambda r: r["place"])
    seen = set()
    for r in order:
        assert r["parent_id"] is None or r["parent_id"] in seen
        seen.add(r["message_id"])


def test_empty_table_and_no_python(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert conversations(df).collect() == []
    plan = df.select(passages("text").alias("p")).withColumn("n", F.size("p"))._jdf.queryExecution().toString()
    assert "Python" not in plan
