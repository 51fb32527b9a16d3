"""The operators over their whole tables, with production parameters, and SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeloom.llm import (
    codes,
    decontamination,
    embeddings,
    interactions,
    language,
    packing,
    pii,
    quality,
    quotation,
    revisits,
    sharding,
    simhash,
    toxicity,
)
from gradeloom.sources.readers import read_table

SHARDS = 16


def _crc(column: str):
    return F.crc32(F.col(column).cast("string"))


def op1_sharding(spark: SparkSession, folder: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = read_table(spark, folder, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    return sharding.shard_rows(docs, ["doc_id", "text_crc32", "size"], SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "row_number",
    )


def op2_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    found = embeddings.near_links(read_table(spark, folder, "embeddings"))
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    return found.select("vec_id", "n_links", "component_id", kept.alias("kept"))


def quoted_messages(conversations: DataFrame) -> DataFrame:
    """Conversations as mail: a turn quotes the turn before it, which quotes the one before that."""
    own = conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))

    def back(by: int, mark: str, name: str) -> DataFrame:
        lines = F.transform(F.split("text", "\n"), lambda line: F.concat(F.lit(mark), line))
        return own.select("conv_id", (F.col("turn") + by).alias("turn"), F.concat(F.array_join(lines, "\n"), F.lit("\n")).alias(name))

    mail = own.join(back(1, "> ", "q1"), ["conv_id", "turn"], "left").join(back(2, "> > ", "q2"), ["conv_id", "turn"], "left")
    text = F.concat(F.coalesce("q2", F.lit("")), F.coalesce("q1", F.lit("")), F.col("text"))
    return mail.select(F.concat_ws("/", "conv_id", "turn").alias("message_id"), "conv_id", F.col("turn").alias("sent"), text.alias("text"))


def op3_quotation(spark: SparkSession, folder: str) -> DataFrame:
    mail = quoted_messages(read_table(spark, folder, "conversations"))
    return quotation.conversations(mail, scope="conv_id")


def capture_records(pages: DataFrame) -> DataFrame:
    """Pages as crawl records: each was fetched in full at second 100 * page_id and asked for again
    two days later, when the server said it was not modified; pages of an even number of
    bytes were asked for once more, a second before the full response."""
    etag, t = F.concat(F.lit('"'), F.md5("html"), F.lit('"')), F.col("page_id") * 100
    full = F.create_map(F.lit("content-type"), F.lit("text/html"), F.lit("content-length"), F.octet_length("html").cast("string"), F.lit("etag"), etag, F.lit("x-served"), F.lit("full"))
    again = F.create_map(F.lit("ETag"), etag, F.lit("Date"), t.cast("string"), F.lit("Content-Length"), F.lit("0"), F.lit("X-Served"), F.lit("again"))
    kinds = [("response", 0, 0, full), ("revisit", 1, 172_800, again), ("revisit", 2, -1, again)]
    records = [
        F.struct((F.col("page_id") * 4 + n).alias("record_id"), F.lit(kind).alias("kind"), "url", (t + shift).alias("at"), headers.alias("headers"))
        for kind, n, shift, headers in kinds
    ]
    early = F.octet_length("html") % 2 == 0
    return pages.select(F.explode(F.when(early, F.array(*records)).otherwise(F.array(*records[:2]))).alias("r")).select("r.*")


def op4_revisits(spark: SparkSession, folder: str) -> DataFrame:
    found = revisits.resolve(capture_records(read_table(spark, folder, "pages")))
    headers = F.array_join(F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))), "\n")
    return found.select("record_id", "url_key", "at", "refers_to", "state", headers.alias("headers"))


def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, folder, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op6_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    found = docs.select("doc_id", pii.find(pii.fit(docs)).alias("f"))
    counts = [F.expr(f"cast(size(filter(f.base, m -> m.k = {k})) as long)").alias(f"n_{name}") for k, name in enumerate(pii.KINDS)]
    return found.select("doc_id", *counts, F.sha2(pii.span_list("f.base"), 256).alias("base_sha256"), pii.span_list("f.spans").alias("spans"))


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.token_pieces(
        read_table(spark, folder, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )
    return packing.pack(pieces)


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contained_items(
        read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark")
    )


def language_model(spark: SparkSession, folder: str) -> language.Compression:
    """Learnt from the documents whose doc_id is not held out."""
    return language.fit(read_table(spark, folder, "documents").where(_crc("doc_id") % 4 != 2))


def op9_language(spark: SparkSession, folder: str) -> DataFrame:
    found = language.identify(read_table(spark, folder, "documents"), language_model(spark, folder))
    held_out = F.coalesce(_crc("doc_id") % 4 == 2, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "margin", "accepted")


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = read_table(spark, folder, "documents"), read_table(spark, folder, "labels")
    model = toxicity.fit(docs, labels.where(_crc("doc_id") % 5 != 0))
    held_out = F.coalesce(_crc("doc_id") % 5 == 0, F.lit(False))
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op11_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = read_table(spark, folder, "documents"), read_table(spark, folder, "labels")
    learnt = _crc("doc_id") % 3 != 1
    model = quality.fit(docs.where(learnt), labels.where(learnt))
    held_out = F.coalesce(_crc("doc_id") % 3 == 1, F.lit(False))
    return quality.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op12_codes(spark: SparkSession, folder: str) -> DataFrame:
    return codes.compress(read_table(spark, folder, "embeddings"))


def op13_interactions(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = read_table(spark, folder, "documents"), read_table(spark, folder, "labels")
    return interactions.audit(interactions.document_masks(docs, labels))


QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_embeddings": op2_embeddings,
    "op3_quotation": op3_quotation,
    "op4_revisits": op4_revisits,
    "op5_simhash": op5_simhash,
    "op6_pii": op6_pii,
    "op7_packing": op7_packing,
    "op8_decontamination": op8_decontamination,
    "op9_language": op9_language,
    "op10_toxicity": op10_toxicity,
    "op11_quality": op11_quality,
    "op12_codes": op12_codes,
    "op13_interactions": op13_interactions,
}

_WORDS = """
{name}_words AS (SELECT {id} AS id, [x for x in string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') if x <> ''] AS w FROM {table})"""

#: Shingles of k words, in texts of k words or more.
_SHINGLED = "list_distinct([array_to_string(w[i:i + k - 1], ' ') for i in range(1, len(w) - k + 2)])"

_KEY = """regexp_replace(regexp_replace(lower(regexp_extract(bare, '^[^/?]*', 0)), '^www[0-9]*[.]', ''), ':(80|443)$', '')
    || regexp_replace(regexp_extract(substr(bare, length(regexp_extract(bare, '^[^/?]*', 0)) + 1), '^[^?]*', 0), '/+$', '')
    || CASE WHEN len(params) > 0 THEN '?' || array_to_string(list_sort(params), '&') ELSE '' END"""



def _codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Every round spelt out: distances of all parts to all entries, the nearest, the means."""
    out = [
        f"""v AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id, q) AS r, vec_id, label, q, len(q) // {parts} AS w
  FROM (SELECT vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS q FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0))""",
        f"x AS MATERIALIZED (SELECT r, p, j, q[p * w + j + 1] AS c FROM v, range({parts}) a(p), range(w) b(j))",
        f"b0 AS MATERIALIZED (SELECT p, r - 1 AS e, j, c AS m FROM x WHERE r <= {entries})",
    ]
    for n in range(rounds + 1):
        out.append(
            f"""a{n} AS MATERIALIZED (SELECT r, p, min(struct_pack(d := d, e := e)) AS best FROM (SELECT r, x.p, e, sum((c - m) * (c - m))::BIGINT AS d
    FROM x JOIN b{n} b ON x.p = b.p AND x.j = b.j GROUP BY ALL) GROUP BY ALL)"""
        )
        out.append(
            f"""b{n + 1} AS MATERIALIZED (SELECT p, e, j, coalesce(s, m) AS m FROM b{n} LEFT JOIN
    (SELECT p, best.e AS e, j, floor(sum(c) / count(*)::DOUBLE)::BIGINT AS s FROM x JOIN a{n} USING (r, p) GROUP BY ALL) USING (p, e, j))"""
        )
    return f"""WITH {", ".join(out)},
o AS (SELECT r, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error FROM a{rounds} GROUP BY r)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
  (SELECT sha256(string_agg(m::VARCHAR, ',' ORDER BY p, e, j)) FROM b{rounds}) AS codebooks_sha256
FROM v JOIN o USING (r)"""


_INTERACTIONS = """WITH RECURSIVE t AS MATERIALIZED (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
    [x for x in string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+') if x <> ''] AS w FROM documents),
l AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY doc_id),
s AS (SELECT text, min(doc_id) AS least FROM t GROUP BY text),
d AS MATERIALIZED (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    concat(CASE WHEN len(w) < 100 THEN 'A' ELSE '' END, CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END,
      CASE WHEN 100 * length(regexp_replace(t.text, '[^A-Z]', '', 'g')) > 10 * length(t.text) THEN 'C' ELSE '' END,
      CASE WHEN regexp_matches(t.text, '[#$%&*|]') THEN 'D' ELSE '' END, CASE WHEN doc_id > least THEN 'E' ELSE '' END) AS fails
  FROM t JOIN s USING (text) LEFT JOIN l USING (doc_id)),
m AS MATERIALIZED (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM d GROUP BY ALL),
o AS (SELECT '' AS o UNION ALL SELECT o || f FROM o, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f) WHERE NOT contains(o, f)),
g AS MATERIALIZED (SELECT o AS filter_order, i AS step, substr(o, i, 1) AS f, substr(o, 1, i - 1) AS before FROM o, range(1, 6) r(i) WHERE length(o) = 5),
c AS MATERIALIZED (SELECT part, filter_order, step::INT AS step, f,
    coalesce(sum(n) FILTER (NOT late AND NOT contains(fails, f)), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (NOT late AND contains(fails, f)), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (late AND contains(fails, f)), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (fails = f), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (NOT late AND contains(fails, f)), 0)::BIGINT AS good_lost, coalesce(sum(toxic) FILTER (NOT late AND contains(fails, f)), 0)::BIGINT AS toxic_lost
  FROM (SELECT *, fails <> translate(fails, before, '') AS late FROM m, g) GROUP BY ALL)
SELECT * EXCLUDE (f), sum(removed) OVER (PARTITION BY part, f)::BIGINT AS shapley FROM c"""

ORACLE = {
    "op12_codes": _codes_sql(),
    "op13_interactions": _INTERACTIONS,
    "op3_quotation": """WITH RECURSIVE c AS (
  SELECT conv_id, turn, coalesce(text, '') AS text, concat(conv_id, '/', turn) AS id,
    trim(regexp_replace(lower(coalesce(text, '')), '\\s+', ' ', 'g')) AS unit FROM conversations),
u AS (SELECT conv_id, turn, id, unit FROM c WHERE unit <> ''
  UNION SELECT conv_id, turn, id, trim(regexp_replace(lower(x), '\\s+', ' ', 'g'))
    FROM (SELECT conv_id, turn, id, unnest(string_split(text, chr(10))) AS x FROM c)
    WHERE trim(regexp_replace(lower(x), '\\s+', ' ', 'g')) <> ''),
q AS (SELECT b.id, b.conv_id, b.turn, d, a.unit, a.id AS quoted FROM range(1, 3) r(d), c b JOIN c a
    ON a.conv_id = b.conv_id AND a.turn = b.turn - d),
l AS (SELECT q.id, q.d, min(struct_pack(t := u.turn, i := u.id)) FILTER (u.conv_id = q.conv_id) AS near,
    min(struct_pack(t := u.turn, i := u.id)) AS far FROM q LEFT JOIN u ON u.unit = q.unit AND u.turn < q.turn GROUP BY q.id, q.d),
o AS (SELECT id, d, coalesce(near, far) AS o FROM l),
p AS (SELECT c.id, c.turn, c.text, (SELECT arg_min(o.o.i, o.d) FROM o WHERE o.id = c.id AND o.o IS NOT NULL) AS parent,
    (SELECT count(*) FROM o WHERE o.id = c.id) AS n_quotes, (SELECT count(o.o) FROM o WHERE o.id = c.id) AS n_linked FROM c),
t AS (SELECT id, id AS root, 0 AS level FROM p WHERE parent IS NULL
  UNION ALL SELECT p.id, t.root, t.level + 1 FROM p JOIN t ON p.parent = t.id)
SELECT p.id AS message_id, parent AS parent_id, root AS thread_id, level::INT AS level,
  row_number() OVER (PARTITION BY root ORDER BY level, turn, p.id) - 1 AS place, n_quotes, n_linked,
  trim(text, ' ' || chr(9) || chr(10) || chr(13)) AS body
FROM p JOIN t USING (id)""",
    "op4_revisits": f"""WITH k AS (SELECT page_id, html, {_KEY} AS url_key
  FROM (SELECT *, [x for x in string_split(regexp_extract(bare, '[?](.*)$', 1), '&') if x <> '' AND NOT starts_with(x, 'utm_')] AS params
  FROM (SELECT page_id, html, regexp_replace(regexp_replace(url, '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare FROM pages))),
v AS (SELECT page_id * 4 + 1 AS record_id, page_id, html, url_key, page_id * 100 + 172800 AS at FROM k
  UNION ALL SELECT page_id * 4 + 2, page_id, html, url_key, page_id * 100 - 1 FROM k WHERE strlen(html) % 2 = 0),
r AS (SELECT page_id * 4 AS record_id, html, url_key, page_id * 100 AS at FROM k)
SELECT v.record_id, v.url_key, v.at, CASE WHEN r.html = v.html THEN r.record_id END AS refers_to,
  CASE WHEN r.record_id IS NULL THEN 'no earlier response' WHEN r.html <> v.html THEN 'validators differ'
    ELSE 'resolved' END AS state,
  CASE WHEN r.html = v.html THEN concat_ws(chr(10), concat('content-length: ', strlen(r.html)), 'content-type: text/html',
    concat('date: ', v.page_id * 100), concat('etag: "', md5(v.html), '"'), 'x-served: full') END AS headers
FROM v ASOF LEFT JOIN r ON v.url_key = r.url_key AND v.at > r.at""",
    "op8_decontamination": "WITH "
    + _WORDS.format(name="item", id="item_id", table="benchmark")
    + ","
    + _WORDS.format(name="doc", id="doc_id", table="documents")
    + f""",
i AS (SELECT id, k, len(s) AS n, unnest(s) AS s FROM (SELECT id, k, {_SHINGLED} AS s FROM (SELECT *, least(5, len(w)) AS k FROM item_words) WHERE k > 0)),
d AS (SELECT id, k, unnest({_SHINGLED}) AS s FROM doc_words, (SELECT DISTINCT k FROM i) WHERE len(w) >= k)
SELECT d.id AS doc_id, i.id AS item_id, n AS n_shingles, count(*) AS n_shared, count(*) / n AS containment
FROM d JOIN i USING (s, k) GROUP BY d.id, i.id, n HAVING count(*) >= ceil(0.8 * n - 1e-9)""",
}
