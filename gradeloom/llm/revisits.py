"""Not-modified revisits of a crawl, resolved to the full responses they stand for.

A revisit record says that a page had not changed. It belongs to the latest earlier full response of
the same canonical URL, if its validators agree with those of that response; its headers are then the
response's, updated by those that a not-modified answer may bring.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeloom.llm.shared import in_order, keep

#: The headers that a 304 answer brings by HTTP's rules.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")


def canonical_url(url: Column | str) -> Column:
    """Host in lower case without `www.` and default port, path without slashes at its end, parameters
    sorted and without `utm_*`; no scheme, no fragment. Null for null."""
    bare = F.regexp_replace(F.regexp_replace(url, "#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_extract(bare, "^[^/?]*", 0)
    params = F.filter(F.split(F.regexp_extract(bare, "[?](.*)$", 1), "&"), lambda p: (p != "") & ~p.startswith("utm_"))
    parts = F.struct(bare.alias("bare"), host.alias("host"), params.alias("params"))

    def joined(p: Column) -> Column:
        name = F.regexp_replace(F.regexp_replace(F.lower(p["host"]), "^www[0-9]*[.]", ""), ":(80|443)$", "")
        path = F.regexp_extract(F.substr(p["bare"], F.length(p["host"]) + 1), "^[^?]*", 0)
        query = F.when(F.size(p["params"]) > 0, F.concat(F.lit("?"), F.array_join(F.array_sort(p["params"]), "&"))).otherwise("")
        return F.concat(name, F.regexp_replace(path, "/+$", ""), query)

    return F.element_at(F.transform(F.array(parts), joined), 1)


def lowered(headers: Column) -> Column:
    """Header names in lower case; of names that differ in case alone the last one counts."""
    named = F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(F.trim(e["key"])).alias("key"), e["value"].alias("value")))
    last = F.transform(
        F.array_distinct(F.transform(named, lambda e: e["key"])),
        lambda k: F.struct(k.alias("key"), F.element_at(F.filter(named, lambda e: e["key"] == k), -1)["value"].alias("value")),
    )
    return F.map_from_entries(F.coalesce(last, F.array().cast("array<struct<key:string,value:string>>")))


FILLED = "rid long, key string, revisit boolean, found long, open boolean, tail boolean, part int"


def _fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The last response of each row's key so far in this partition. `open`: none seen yet, and the key
    is the first of the partition, so the partitions before may know one. `tail`: the last row."""
    part, first, key, found, waiting = TaskContext.get().partitionId(), None, None, None, None
    for batch in batches:
        if len(batch) == 0:
            continue
        first = batch["key"].iloc[0] if first is None else first
        rid = batch["rid"].where(~batch["revisit"]).astype("Int64")
        if key == batch["key"].iloc[0] and found is not None and rid.isna().iloc[0]:
            rid.iloc[0] = found
        last = rid.groupby(batch["key"].to_numpy(), sort=False).ffill()
        key, found = batch["key"].iloc[-1], None if pd.isna(last.iloc[-1]) else int(last.iloc[-1])
        out = pd.DataFrame({"rid": batch["rid"], "key": batch["key"], "revisit": batch["revisit"], "found": last})
        out["open"], out["tail"], out["part"] = last.isna() & (out["key"] == first), False, part
        if waiting is not None:
            yield waiting
        waiting = out
    if waiting is not None:
        waiting.iloc[-1, waiting.columns.get_loc("tail")] = True
        yield waiting


def last_before(rows: DataFrame) -> DataFrame:
    """rid and found (rid of the latest earlier response of the same key) of the revisits in
    rows (rid, key, at, revisit).

    The rows are dealt out by key and time together, so a URL that owns a third of all rows lies in many
    partitions; what a partition needs from those before it is one row each.
    """
    ordered = in_order(rows, ["key", "at", F.col("revisit").cast("int") * -1, "rid"])
    filled = keep(ordered.select("rid", "key", "revisit").mapInPandas(_fill, FILLED))
    carried, key, found = [], None, None
    for t in filled.where("tail").orderBy("part").collect():  # one row per partition
        carried.append((t["part"], key, found))
        key, found = t["key"], t["found"] if t["found"] is not None else (found if t["key"] == key else None)
    spark = rows.sparkSession
    before = spark.createDataFrame(carried, "part int, before_key string, before long")
    hit = F.when(F.col("open") & (F.col("key") == F.col("before_key")), F.col("before"))
    joined = filled.where("revisit").join(F.broadcast(before), "part", "left")
    return joined.select("rid", F.coalesce("found", hit).alias("found"))


def resolve(
    records: DataFrame,
    key: str = "record_id",
    kind: str = "kind",
    url: str = "url",
    at: str = "at",
    headers: str = "headers",
    permitted: tuple[str, ...] = PERMITTED,
) -> DataFrame:
    """One row per revisit: record_id, url_key, at, refers_to, state, headers.

    `kind` is `response` or `revisit`; other records are left aside. A response counts for revisits
    later than it; of responses at one time, the one that is written last. state is `resolved`,
    `no earlier response`, `validators differ`, or `no url or time` where one of them is null. Entity tags are compared without their
    weakness mark, then Last-Modified as text; a revisit that shares no validator with the response is
    taken at its word. refers_to and headers are null unless resolved. Header names are in lower case.
    """
    rows = records.select(
        F.col(key).alias("record_id"), (F.col(kind) == "revisit").alias("revisit"), canonical_url(F.col(url)).alias("key"),
        F.col(at).alias("at"), lowered(F.col(headers)).alias("headers"),
    ).where(F.col(kind).isin("response", "revisit"))
    rows = keep(rows.withColumn("rid", F.monotonically_increasing_id()))
    placed = rows.where(F.col("key").isNotNull() & F.col("at").isNotNull()).select("rid", "key", "at", "revisit")
    found = keep(last_before(placed))
    responses = rows.where(~F.col("revisit")).select(F.col("rid").alias("found"), F.col("record_id").alias("response_id"), F.col("headers").alias("full"))
    # Responses are single by rid, so only the side of the revisits can be uneven, and Spark splits that.
    met = rows.where("revisit").join(found, "rid", "left")
    met = keep(met).join(responses, "found", "left")
    tag = lambda h: F.regexp_replace(F.trim(h["etag"]), "^W/", "")
    own, full = F.col("headers"), F.col("full")
    same = F.coalesce(tag(own) == tag(full), own["last-modified"] == full["last-modified"], F.lit(True))
    state = (
        F.when(F.col("key").isNull() | F.col("at").isNull(), "no url or time")
        .when(F.col("found").isNull(), "no earlier response")
        .when(~same, "validators differ")
        .otherwise("resolved")
    )
    brought = F.map_filter(own, lambda k, _: k.isin(*permitted))
    merged = F.map_concat(F.map_filter(full, lambda k, _: ~F.array_contains(F.map_keys(brought), k)), brought)
    done = F.col("state") == "resolved"
    return met.withColumn("state", state).select(
        "record_id", F.col("key").alias("url_key"), "at", F.when(done, F.col("response_id")).alias("refers_to"), "state", F.when(done, merged).alias("headers")
    )
