import random

import pytest
from pyspark.sql import functions as F

from gradeloom.llm.revisits import canonical_url, resolve

SCHEMA = "record_id long, kind string, url string, at long, headers map<string,string>, state string"


@pytest.mark.parametrize(
    ("url", "key"),
    [
        ("http://WWW.Example.org:80/a/?b=2&a=1&utm_source=x#frag", "example.org/a?a=1&b=2"),
        ("https://example.org", "example.org"),
        ("https://example.org/", "example.org"),
        ("example.org/A/B//", "example.org/A/B"),
        ("http://h/?", "h"),
        ("", ""),
        (None, None),
    ],
)
def test_canonical_urls(spark, url, key):
    df = spark.createDataFrame([(url,)], "u string")
    assert df.select(canonical_url(F.col("u"))).first()[0] == key


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    return {r["record_id"]: r for r in resolve(df).collect()}


def test_states_and_headers(spark):
    full = {"ETag": 'W/"1"', "Content-Length": "10", "X": "a", "Last-Modified": "Mon"}
    got = run(
        spark,
        [
            (1, "response", "http://h/a", 10, full),
            (2, "revisit", "https://www.h/a/", 20, {"etag": '"1"', "Date": "today", "content-length": "0", "x": "b"}),
            (3, "revisit", "http://h/a", 10, {"etag": '"1"'}),  # not later
            (4, "revisit", "http://h/a", 30, {"etag": '"2"'}),
            (5, "revisit", "http://h/a", 30, {"last-modified": "Mon", "etag": None}),
            (6, "revisit", "http://h/a", 30, None),
            (7, "revisit", None, 30, {}),
            (8, "revisit", "http://h/a", None, {}),
            (9, "request", "http://h/a", 15, {}),
            (10, "revisit", "http://other/", 15, {}),
            (11, None, "http://other/", 1, {}),
        ],
    )
    assert {k: (r["refers_to"], r["state"]) for k, r in got.items()} == {
        2: (1, "resolved"),
        3: (None, "no earlier response"),
        4: (None, "validators differ"),
        5: (1, "resolved"),
        6: (1, "resolved"),
        7: (None, "no url or time"),
        8: (None, "no url or time"),
        10: (None, "no earlier response"),
    }
    assert got[2]["headers"] == {"etag": '"1"', "content-length": "10", "x": "a", "last-modified": "Mon", "date": "today"}
    assert got[4]["headers"] is None


def test_hot_url_against_a_plain_loop(spark):
    rnd, rows = random.Random(3), []
    for i in range(3000):
        url = "http://hot/" if i % 2 else f"http://h{rnd.randrange(50)}/"
        kind = "response" if rnd.random() < 0.02 else "revisit"
        rows.append((i, kind, url, rnd.randrange(400), {}))
    got = run(spark, rows)
    for i, kind, url, at, _ in rows:
        if kind == "revisit":
            earlier = [(r[3], r[0]) for r in rows if r[1] == "response" and r[2] == url and r[3] < at]
            assert (got[i]["refers_to"] is None) == (not earlier)
            if earlier:  # of several at that time any one
                assert rows[got[i]["refers_to"]][2:4] == (url, max(earlier)[0])


def test_empty_table_and_repeats(spark):
    assert run(spark, []) == {}
    rows = [(1, "response", "u", 1, {})] * 3 + [(2, "revisit", "u", 2, {})] * 2
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    assert [(r["record_id"], r["refers_to"]) for r in resolve(df).collect()] == [(2, 1), (2, 1)]
