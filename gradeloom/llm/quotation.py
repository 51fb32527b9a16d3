"""Quotation linking: from quoted passages to the messages they come from, and on to conversations.

A line that starts with `>` marks is quoted, its depth is the number of marks. Neighbouring lines of
equal depth form a passage. Passages are normalised (lower case, single spaces) and hashed, and so are
the unquoted passages of every message; equal hashes link a quotation to the message that wrote it.
All of it is DataFrame work; no step holds a conversation in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeloom.llm.shared import keep, numbered

MARKS = r"^[ \t]*+(?:>[ \t]*+)++"


def _let(value: str, name: str, body: str) -> str:
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def passages(text: str) -> Column:
    """The passages of a text in order: structs of depth (0: unquoted) and body, the lines without
    their marks. Null: no passage."""
    line = f"regexp_extract(l, r'{MARKS}', 0)"
    parsed = f"transform(split(`{text}`, r'\\r?\\n', -1), l -> named_struct('depth', char_length(regexp_replace({line}, '[^>]', '')), 'body', regexp_replace(l, r'{MARKS}', '')))"
    bounds = "filter(transform(lines, (l, i) -> if(i = 0 or l.depth != lines[greatest(i - 1, 0)].depth, i, -1)), i -> i >= 0)"
    length = "(if(r + 1 < size(bounds), bounds[least(r + 1, size(bounds) - 1)], size(lines)) - b)"
    one = f"named_struct('depth', lines[b].depth, 'body', array_join(transform(slice(lines, b + 1, {length}), l -> l.body), '\\n'))"
    cut = _let(bounds, "bounds", f"transform(bounds, (b, r) -> {one})")
    return F.expr(f"if(`{text}` is null, array(), {_let(parsed, 'lines', cut)})")


def normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def _hashed(parts: DataFrame) -> DataFrame:
    """Units of each passage (columns body and others): the whole of it, and its lines. `rank` is 0 for
    the whole; `size` is the length of the unit. Blank units are left out."""
    whole = F.array(F.struct(F.lit(0).alias("rank"), normal(F.col("body")).alias("unit")))
    lines = F.transform(F.split("body", "\n"), lambda l: F.struct(F.lit(1).alias("rank"), normal(l).alias("unit")))
    units = parts.withColumn("u", F.explode(F.concat(whole, lines))).where(F.length("u.unit") > 0)
    return units.select(*[c for c in parts.columns if c != "body"], "u.rank", F.length("u.unit").alias("size"), F.md5("u.unit").alias("hash"))


def without_quotes(parts: str) -> Column:
    own = F.filter(parts, lambda p: p["depth"] == 0)
    return F.trim(F.array_join(F.transform(own, lambda p: p["body"]), "\n"), F.lit(" \t\r\n"))


def link_quotes(messages: DataFrame) -> DataFrame:
    """id, run, depth, original for the quoted passages of messages (id, scope, sent, parts).

    The original is the first message that wrote the passage itself and was sent before: in the same
    scope if there is one, else anywhere. The whole passage counts first, then its longest line that is
    found. `original` is null for a passage that nobody wrote. Messages that a third of all replies
    quote are found by joins on keys that are single on one side.
    """
    runs = messages.select("id", "scope", "sent", F.posexplode("parts").alias("run", "p"))
    runs = keep(runs.select("id", "scope", "sent", "run", "p.depth", "p.body"))
    own = messages.select("id", "scope", "sent", without_quotes("parts").alias("body")).union(
        runs.where(F.col("depth") == 0).select("id", "scope", "sent", "body")
    )
    written = _hashed(own.where(F.col("sent").isNotNull()))  # nulls would come first and hide the dated writers
    first = F.min(F.struct("sent", "id")).alias("o")
    here = keep(written.groupBy("hash", "scope").agg(first))
    anywhere = keep(here.groupBy("hash").agg(F.min("o").alias("a")))
    quoted = _hashed(runs.where(F.col("depth") > 0))
    found = quoted.join(here, ["hash", "scope"], "left").join(anywhere, "hash", "left")
    near = F.when(F.col("o.sent") < F.col("sent"), F.col("o"))
    far = F.when(F.col("a.sent") < F.col("sent"), F.col("a"))
    best = F.struct("rank", F.when(near.isNotNull(), 0).otherwise(1).alias("away"), (-F.col("size")).alias("size"), F.coalesce(near, far).alias("o"))
    picked = found.withColumn("best", F.when(F.coalesce(near, far).isNotNull(), best))
    return picked.groupBy("id", "run", "depth").agg(F.min("best").alias("b")).select("id", "run", "depth", F.col("b.o.id").alias("original"), F.col("b.o.sent").alias("original_sent"))


def _roots(parents: DataFrame) -> DataFrame:
    """id, root, level by doubling: each round a message learns of an ancestor twice as far up.

    Messages whose ancestor is known to have none are done and written once; a round reads them only as
    ancestors of those that are not, so long conversations do not make the others go round with them.
    """
    level = F.when(F.col("parent").isNull(), 0).otherwise(1)
    up = keep(parents.select("id", F.coalesce("parent", "id").alias("root"), level.alias("level"), F.col("parent").isNull().alias("done")))
    done, active = up.where("done"), up.where("not done")
    while not active.isEmpty():
        known = done.union(active).select(F.col("id").alias("root"), F.col("root").alias("next"), F.col("level").alias("more"), F.col("done").alias("end"))
        moved = keep(
            active.drop("done").join(known.where("more > 0"), "root", "left").select(
                "id",
                F.coalesce("next", "root").alias("root"),
                (F.col("level") + F.coalesce("more", F.lit(0))).alias("level"),
                F.coalesce("end", F.lit(True)).alias("done"),
            )
        )
        done, active = done.union(moved.where("done")), moved.where("not done")
    return done.drop("done")


def conversations(df: DataFrame, key: str = "message_id", sent: str = "sent", text: str = "text", scope: str | None = None) -> DataFrame:
    """One row per message: message_id, parent_id, thread_id, level, place, n_quotes, n_linked, body.

    parent_id is the latest original among those of the passages quoted at the lowest depth that has
    one; a message that quotes nobody known starts a thread. Threads are ordered by level, then `sent`,
    then id, so a message comes after the one it replies to; `place` is gapless from 0. `body` is the
    text without quotations, trimmed. A null text has an empty body. Rows without a key are left out;
    of rows with equal keys one with the least `sent` and text stays. Without `sent` a message is
    nobody's original and quotes none. `scope` may name a column (a mailbox, a list) in which originals
    are looked for first.
    """
    scoped = F.col(scope) if scope else F.lit(0)
    rows = df.select(F.col(key).alias("id"), scoped.alias("scope"), F.col(sent).alias("sent"), F.col(text).alias("text")).where(F.col("id").isNotNull())
    # Ids are single as a rule; only rows of ids that are not are brought together.
    twice = keep(rows.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id"))
    single = rows.join(twice, "id", "left_anti")
    least = F.min(F.struct("sent", "text", "scope")).alias("m")
    folded = rows.join(twice, "id", "left_semi").groupBy("id").agg(least).select("id", "m.scope", "m.sent", "m.text")
    messages = keep(single.select("id", "scope", "sent", "text").union(folded).withColumn("parts", passages("text")).drop("text"))
    links = keep(link_quotes(messages))
    known = links.where(F.col("original").isNotNull())
    # The lowest depth first, and the latest original at that depth.
    by_depth = known.groupBy("id", "depth").agg(F.max(F.struct("original_sent", "original")).alias("p"))
    parent = by_depth.groupBy("id").agg(F.min(F.struct("depth", "p")).alias("m"))
    parent = keep(parent.select("id", F.col("m.p.original").alias("parent")))
    counts = keep(links.groupBy("id").agg(F.count("*").alias("n_quotes"), F.count("original").alias("n_linked")))
    threads = _roots(messages.select("id").join(parent, "id", "left"))
    ordered, _ = numbered(threads.join(messages.select("id", "sent"), "id"), ["root", "level", "sent", "id"], "at")
    ordered = keep(ordered)
    first = keep(ordered.groupBy("root").agg(F.min("at").alias("first")))
    placed = keep(ordered.join(first, "root").select("id", "root", "level", (F.col("at") - F.col("first")).alias("place")))
    body = messages.select("id", without_quotes("parts").alias("body"))
    out = body.join(placed, "id").join(parent, "id", "left").join(counts, "id", "left")
    return out.select(
        F.col("id").alias("message_id"), F.col("parent").alias("parent_id"), F.col("root").alias("thread_id"), "level", "place",
        F.coalesce("n_quotes", F.lit(0)).alias("n_quotes"), F.coalesce("n_linked", F.lit(0)).alias("n_linked"), F.coalesce("body", F.lit("")).alias("body"),
    )
