"""Language identification by compression.

Each language has a zstandard dictionary of raw content: passages of texts in this language. A text in lower
case is encoded with every dictionary, in blocks so that long texts keep leaning on the dictionary, and belongs
to the language whose encoding is smallest. If the runner-up is nearly as small, the text is rejected.

Lines that many texts share, such as licences and navigation, say where a text is from and not what it is
written in. They are left out of dictionaries and of the texts that are judged, unless nothing else is there.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.llm.shared import keep

UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")
PASSAGE = 128  # characters; dictionaries are made of such pieces
LINE = 32  # shared lines have so many characters at least
LEAST = 8  # bytes that a dictionary needs


@dataclass(frozen=True)
class Compression:
    """Raw dictionaries by language, the most frequent first, and how texts are encoded.

    The levels after the first settle texts whose encodings tie, mostly of a few words. A margin of `least`
    or below is narrow.
    """

    dictionaries: dict[str, bytes] = field(default_factory=dict)
    shared: frozenset[str] = frozenset()
    least: float = 0.0
    levels: tuple[int, ...] = (5, 19)
    block: int = 1024
    scale: float = 8.0  # bytes of difference that divide the odds by e

    def encoders(self) -> list[dict[str, zstandard.ZstdCompressor]]:
        """The compressors of each level by language."""
        out = []
        for level in self.levels:
            by_lang = {}
            for lang, data in self.dictionaries.items():
                content = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                content.precompute_compress(level=level)
                by_lang[lang] = zstandard.ZstdCompressor(
                    level=level, dict_data=content, write_content_size=False, write_checksum=False, write_dict_id=False
                )
            out.append(by_lang)
        return out

    def own(self, text: str) -> str:
        """A text in lower case without the lines that many texts share, or all of it if nothing else has letters."""
        text = text.lower()
        if self.shared:
            lines = [line for line in text.split("\n") if line.strip(" ") not in self.shared]
            body = "\n".join(lines)
            return body if LETTER.search(body) else text
        return text

    def judge(self, text: str | None, encoders: list[dict]) -> tuple[str, float, float]:
        """Language, score and margin: how much larger the second smallest encoding is, as a share."""
        if not text or not self.dictionaries or not LETTER.search(text):
            return UNKNOWN, 0.0, 0.0
        data = f" {self.own(text)} ".encode("utf-8", "surrogatepass")
        blocks = [data[i : i + self.block] for i in range(0, len(data), self.block)]
        sizes = dict.fromkeys(self.dictionaries, 0)
        for by_lang in encoders:
            for lang, encoder in by_lang.items():
                sizes[lang] += sum(len(encoder.compress(b)) for b in blocks)
            ranked = sorted(sizes, key=sizes.get)
            least = sizes[ranked[0]]
            margin = (sizes[ranked[1]] - least) / sizes[ranked[1]] if len(ranked) > 1 else 1.0
            if margin > 0:
                break
        score = 1 / sum(math.exp(max(-700.0, (least - size) / self.scale)) for size in sizes.values())
        return ranked[0], score, margin


def _shared_lines(texts: DataFrame, share: float) -> frozenset[str]:
    """Lines, in lower case, that more than `share` of the sampled texts have, and more than two of them. Their
    number is at most the mean number of lines of a text over `share`."""
    lines = texts.select("h", F.explode(F.array_distinct(F.split(F.lower("t"), "\n"))).alias("line"))
    counted = lines.select("h", F.trim("line").alias("line")).where(F.length("line") >= LINE).groupBy("line").agg(F.count_distinct("h").alias("n"))
    least = max(2.0, share * texts.select("h").distinct().count())
    return frozenset(r["line"] for r in counted.where(F.col("n") > least).select("line").collect())


def fit(
    labelled: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    texts_per_language: int = 1024,
    dictionary_chars: int = 131_072,
    held_per_language: int = 512,
    languages: int = 256,
    share: float = 0.02,
    clear: float = 0.99,
    narrow: float = 0.125,
    **how,
) -> Compression:
    """Dictionaries and the least margin from two bounded samples of labelled rows.

    Of each language about `texts_per_language` texts are taken, those whose keys have the least hashes. They
    share `dictionary_chars` evenly, and a text's share are passages of PASSAGE characters from all over it,
    those with the least hashes of key and place. Lines that more than a `share` of the sampled texts have are left
    out. Another `held_per_language` texts, of keys that dictionaries never take, are judged: `narrow` of the margin that `clear` of
    the right ones exceed is the least margin of the model, so that few texts of a learnt language are below it.

    Only language counts, these passages and shared lines reach the driver; more than `languages` languages are
    refused, as every task holds all dictionaries. Rows whose text or language is null or empty are left out;
    without any row there is no language and every text is `und`. Equal texts of a key count once. A
    language with next to no text has a dictionary all the same, filled up with line breaks.
    """
    rows = labelled.select(F.xxhash64(key).alias("h"), F.col(text).alias("t"), F.col(lang).alias("l"))
    rows = rows.where((F.length("t") > 0) & (F.length("l") > 0)).withColumn("held", F.pmod(F.xxhash64("h"), F.lit(4)) == 0)
    counted = rows.groupBy("l").agg(F.count("*").alias("n"), F.count_if("held").alias("n_held")).limit(languages + 1).collect()
    if len(counted) > languages:
        raise ValueError(f"more than {languages} languages")
    if not counted:
        return Compression(**how)

    def least(n: int, most: int) -> int:
        return 2**63 - 1 if n <= most else -(2**63) + 2**64 * most // n

    limits = [(r["l"], least(r["n"] - r["n_held"], texts_per_language), least(r["n_held"], held_per_language)) for r in counted]
    sampled = rows.join(F.broadcast(labelled.sparkSession.createDataFrame(limits, "l string, most long, most_held long")), "l")
    alone = [r["l"] for r in counted if r["n"] == r["n_held"]]  # all texts of such a language make its dictionary
    if alone:
        sampled = sampled.withColumns({"held": F.col("held") & ~F.col("l").isin(alone), "most": F.greatest("most", "most_held")})
    sampled = keep(sampled.where(F.col("h") <= F.when(F.col("held"), F.col("most_held")).otherwise(F.col("most"))).select("l", "h", "t", "held").distinct())
    learnt = sampled.where("not held")
    shared = _shared_lines(learnt, share)

    texts = {r["l"]: r["n"] for r in learnt.groupBy("l").agg(F.count("*").alias("n")).collect()}
    shares = [(name, max(1, dictionary_chars // PASSAGE // n)) for name, n in texts.items()]
    model = Compression(shared=shared, **how)

    @F.pandas_udf("string")
    def own(texts: pd.Series) -> pd.Series:
        return texts.map(model.own)

    pieces = f"transform(sequence(0, cast((char_length(t) - 1) div {PASSAGE} as int)), i -> struct(xxhash64(h, i) as x, substring(t, i * {PASSAGE} + 1, {PASSAGE}) as t))"
    passages = learnt.withColumn("t", own("t")).join(F.broadcast(labelled.sparkSession.createDataFrame(shares, "l string, k int")), "l")
    passages = passages.select("l", F.explode(F.expr(f"slice(array_sort({pieces}), 1, k)")).alias("p")).select("l", "p.x", "p.t")
    found: dict[str, list] = {}
    for r in sorted(passages.collect()):
        found.setdefault(r["l"], []).append(r["t"])
    counts = {r["l"]: r["n"] for r in counted}
    frequent = sorted(counts, key=lambda name: (-counts[name], name))
    joined = {name: "\n".join(found.get(name, [])).encode("utf-8", "surrogatepass").rjust(LEAST, b"\n") for name in frequent}
    model = replace(model, dictionaries=joined)
    # The margins of texts that dictionaries do not hold.
    judged = identify(sampled.where("held"), model, key="l", text="t").where(F.col("doc_id") == F.col("lang_pred"))
    usual = judged.agg(F.expr(f"percentile(margin, {1 - clear!r}D)").alias("m")).first()["m"]
    return replace(model, least=narrow * (usual or 0.0) if len(joined) > 1 else 0.0)


def identify(df: DataFrame, model: Compression, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, margin, accepted for each row; no shuffle.

    `und` (score 0, not accepted) for a text that is null or has no letter; accepted is false if the margin is
    not above the model's, so texts whose encodings tie are never accepted. Whole texts count, in time that
    grows with their length; repeated rows get equal results.
    """
    kind = df.schema[key].dataType.simpleString()

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoders = model.encoders()
        for batch in batches:
            rows = [model.judge(t, encoders) for t in batch["text"]]
            out = pd.DataFrame(rows, columns=["lang_pred", "score", "margin"])
            out.insert(0, "doc_id", batch["doc_id"].array)
            out["accepted"] = (out["margin"] > model.least) & (out["lang_pred"] != UNKNOWN)
            yield out

    source = df.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    return source.mapInPandas(predict, f"doc_id {kind}, lang_pred string, score double, margin double, accepted boolean")


def accepted_rows(df: DataFrame, model: Compression, text: str = "text") -> DataFrame:
    """The rows of `df` that `identify` accepts, unchanged."""
    names = df.columns

    @F.pandas_udf("boolean")
    def accepted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoders = model.encoders()
        for texts in batches:
            judged = (model.judge(t, encoders) for t in texts)
            yield pd.Series([lang != UNKNOWN and margin > model.least for lang, _, margin in judged], dtype=bool)

    return df.where(accepted(F.col(text))).select(*names)
