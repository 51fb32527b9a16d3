"""Sampling, ordering, batching and splitting queries."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeloom.functions.chat import render_chat
from gradeloom.functions.text import word_count
from gradeloom.operators import order as O
from gradeloom.operators import sampling as S
from gradeloom.operators.conversations import with_whole
from gradeloom.plans.inputs import TURN_SQL, conversations
from gradeloom.session import shared_dir
from gradeloom.sources.readers import read_table

SEED = 42
RANGE_ROWS = 500
_KEY = ["o_orderkey"]


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")


def subsample_exact(spark: SparkSession, folder: str) -> DataFrame:
    return S.subsample_exact(_orders(spark, folder), 64, _KEY, SEED)


def subsample_large(spark: SparkSession, folder: str) -> DataFrame:
    """A sample too large for a top-n: whole hash buckets and one ranked bucket."""
    return S.subsample_exact(_orders(spark, folder), 12_345, _KEY, SEED)


def _uneven(spark: SparkSession, folder: str) -> DataFrame:
    """Lines under a key that owns a third of them."""
    lines = read_table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return lines.withColumn("key", F.when(F.col("l_orderkey") % 3 == 0, F.lit(0)).otherwise(F.col("l_orderkey")))


def subsample_repeats(spark: SparkSession, folder: str) -> DataFrame:
    """Half of the lines; where the sample ends within a key, the hash of the row decides."""
    return S.subsample_exact(_uneven(spark, folder), 30_000, ["key"], SEED)


def subsample_within_key(spark: SparkSession, folder: str) -> DataFrame:
    """A sample that ends within the key that owns a third of the lines."""
    lines = _uneven(spark, folder).withColumn("key", F.col("key") == 0)
    return S.subsample_exact(lines, 12_000, ["key"], SEED)


def epoch_order(spark: SparkSession, folder: str) -> DataFrame:
    return S.epoch_order(_orders(spark, folder), _KEY, SEED, 0)


def epoch_reshuffle(spark: SparkSession, folder: str) -> DataFrame:
    return S.epoch_order(_orders(spark, folder), _KEY, SEED, 1)


def epoch_order_copies(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that share their key take neighbouring places."""
    lines = read_table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber")
    return S.epoch_order_with_copies(lines, ["l_orderkey", "l_linenumber"], SEED)


def resume_epoch(spark: SparkSession, folder: str) -> DataFrame:
    return S.resume_from(epoch_order(spark, folder), 1000)


def order_across_epochs(spark: SparkSession, folder: str) -> DataFrame:
    """A thousand places in a row: the end of the first epoch and the beginning of the second."""
    orders, path = _orders(spark, folder), shared_dir(spark)
    for epoch in (0, 1):
        O.write_epoch(orders, _KEY, SEED, epoch, path, range_rows=RANGE_ROWS)
    n = orders.count()
    return O.read_places(spark, path, n - 600, 1000, n, RANGE_ROWS).select("o_orderkey", "o_orderpriority", "epoch", "pos", "place")


def batch_plan(spark: SparkSession, folder: str) -> DataFrame:
    batch = S.global_batch(micro=8, grad_accum=4, gpus=8)
    return S.batch_plan(epoch_order(spark, folder), batch).select("o_orderkey", "step", "slot")


def prompt_group_expand(spark: SparkSession, folder: str) -> DataFrame:
    return S.prompt_group_expand(_orders(spark, folder).select("o_orderkey"), 8)


def length_budget(spark: SparkSession, folder: str) -> DataFrame:
    """Words of the whole conversation against the limit; its parts share the verdict."""
    words = word_count(render_chat(F.col("messages"))).cast("long")
    counted = with_whole(conversations(spark, folder).withColumn("words", words), {"whole": (F.sum("words"), F.col("words"))})
    flagged = S.length_budget(counted, F.col("whole"), 400, flag_only=True)
    return flagged.select("conv_id", "part", "n_parts", "length", "within_budget")


def hash_split(spark: SparkSession, folder: str) -> DataFrame:
    return S.mark_split(_orders(spark, folder), _KEY, 0.1, SEED).select("o_orderkey", F.col("split").alias("part"))


_ORDER = "md5('42:0:' || o_orderkey), o_orderkey"
_PLACED = f"""(SELECT o_orderkey, o_orderpriority, row_number() OVER (ORDER BY {_ORDER}) - 1 AS pos FROM orders)"""


def _sampled_sql(key: str, n: int) -> str:
    order = "md5('42:' || key), key, md5('42:' || key || ':' || l_orderkey || ':' || l_linenumber || ':' || l_partkey)"
    return f"""SELECT l_orderkey, l_linenumber, l_partkey, key FROM (SELECT l_orderkey, l_linenumber, l_partkey,
        {key} AS key FROM lineitem) ORDER BY {order} LIMIT {n}"""


QUERIES = {
    "subsample_exact": subsample_exact,
    "subsample_large": subsample_large,
    "subsample_repeats": subsample_repeats,
    "subsample_within_key": subsample_within_key,
    "epoch_order": epoch_order,
    "epoch_reshuffle": epoch_reshuffle,
    "epoch_order_copies": epoch_order_copies,
    "resume_epoch": resume_epoch,
    "order_across_epochs": order_across_epochs,
    "batch_plan": batch_plan,
    "prompt_group_expand": prompt_group_expand,
    "length_budget": length_budget,
    "hash_split": hash_split,
}

ORACLE = {
    "subsample_exact": """SELECT o_orderkey, o_orderpriority FROM orders
        ORDER BY md5('42:' || o_orderkey), o_orderkey LIMIT 64""",
    "subsample_large": """SELECT o_orderkey, o_orderpriority FROM orders
        ORDER BY md5('42:' || o_orderkey), o_orderkey LIMIT 12345""",
    "subsample_repeats": _sampled_sql("CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_orderkey END", 30_000),
    "subsample_within_key": _sampled_sql("l_orderkey % 3 = 0", 12_000),
    "epoch_order": f"SELECT * FROM {_PLACED}",
    "epoch_reshuffle": f"SELECT * FROM {_PLACED.replace('42:0:', '42:1:')}",
    "epoch_order_copies": """SELECT l_orderkey, l_linenumber, row_number() OVER (
        ORDER BY md5('42:0:' || l_orderkey || ':' || l_linenumber), l_orderkey, l_linenumber) - 1 AS pos
        FROM lineitem""",
    "resume_epoch": f"SELECT * FROM {_PLACED} WHERE pos >= 1000",
    "order_across_epochs": f"""SELECT * FROM (SELECT *, 0 AS epoch, pos AS place FROM {_PLACED} UNION ALL
        SELECT *, 1, pos + (SELECT count(*) FROM orders) FROM {_PLACED.replace('42:0:', '42:1:')})
        WHERE place - (SELECT count(*) FROM orders) BETWEEN -600 AND 399""",
    "batch_plan": f"""SELECT o_orderkey, CAST(floor(pos / 256) AS BIGINT) AS step, pos % 256 AS slot FROM {_PLACED}""",
    "prompt_group_expand": "SELECT o_orderkey, g AS sample_no FROM orders, unnest([0, 1, 2, 3, 4, 5, 6, 7]) AS t(g)",
    "length_budget": f"""SELECT conv_id, unnest(range(n_parts)) AS part, n_parts, n AS length, n <= 400 AS within_budget
        FROM (SELECT conv_id, CAST(floor(max(turn) / 1024) AS BIGINT) + 1 AS n_parts, len(regexp_extract_all(string_agg(
            '<|im_start|>' || role || chr(10) || content || '<|im_end|>' || chr(10), '' ORDER BY turn),
            '[^\\s\\p{{Z}}]+')) AS n
        FROM {TURN_SQL} GROUP BY conv_id)""",
    "hash_split": """SELECT o_orderkey, CASE WHEN substr(md5('42:' || o_orderkey), 1, 8) < '19999999'
        THEN 'validation' ELSE 'train' END AS part FROM orders""",
}
