"""Every registered query against its SQL on the smallest tables, and the shape of the plans."""

import re

import pytest

import __spark_entry__ as entry
from compare import connect, difference
from gradeloom.plans import chats, grading, rollouts, samples

# The numbered operators and the pipeline have tests of their own, and not all of them have SQL.
NUMBERED = re.compile(r"op\d+_|pipeline$")
QUERIES = {name: query for name, query in entry.queries().items() if not NUMBERED.match(name)}
ORACLE = {name: sql for name, sql in entry.oracle_sql().items() if not NUMBERED.match(name)}
TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, small, con, name):
    df = QUERIES[name](spark, small)
    types = {r[0]: r[1] for r in con.execute("DESCRIBE " + ORACLE[name]).fetchall()}
    assert {k: TYPES[v] for k, v in df.dtypes} == types
    assert difference(df, con, ORACLE[name]) is None


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() == 6000 and "advantage" in df.columns


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return len(re.findall(r"Exchange (hash|range|single|round)", plan(df)))


@pytest.mark.parametrize("query", [grading.gsm8k_score, grading.score_by_data_source, chats.trl_grpo_format, chats.slime_format, samples.prompt_group_expand])
def test_projections_do_not_shuffle(spark, small, query):
    assert exchanges(query(spark, small)) == 0


def test_no_python_workers(spark, small):
    for name, query in QUERIES.items():
        if not name.startswith("stream") and not name.endswith("file"):
            assert "Python" not in plan(query(spark, small)), name


def test_scan_reads_only_what_is_used(spark, small):
    scan = plan(grading.gsm8k_score(spark, small)).split("ReadSchema: ", 1)[1]
    assert scan.startswith("struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int,l_quantity:double>")


@pytest.mark.parametrize("query", [chats.chat_render, chats.chat_render_turns])
def test_texts_of_conversations_are_shuffled_once(spark, small, query):
    df = query(spark, small)
    df.collect()
    ran = plan(df).split("Initial Plan")[0]
    assert len(re.findall(r"Exchange hashpartitioning\(conv_id#\d+L, _grouping", ran)) == 1
    assert "SortMergeJoin" not in ran


def test_group_summary_combines_before_its_shuffle(spark, small):
    text = plan(rollouts.group_summary(spark, small))
    assert "partial_avg" in text and exchanges(rollouts.group_summary(spark, small)) == 1
