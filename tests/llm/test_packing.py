import zlib

import numpy as np
import pytest
from public_tokenizers import PATTERN, path
from tokenizers import Tokenizer

from gradeloom.llm.packing import Capacity, best_fit, pack, packed_sequences, token_pieces

TEXTS = ["one two three", None, "", "word " * 6000, "ab <|endoftext|> cd", "Éa ñ ß \U0001f600\n\n x", "a" * 9000, "one two three"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i % 7, t, 5) for i, t in enumerate(TEXTS)], "doc_id long, text string, piece int")


def plain_pieces():
    tokenizer, out = Tokenizer.from_file(path("byte_bpe_50k.json")), []
    for i, t in enumerate(TEXTS):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        first = len(ids) % 2048 or 2048
        edges = [0, *range(first, len(ids) + 1, 2048)]
        for piece, (a, b) in enumerate(zip(edges, edges[1:])):
            out.append((i % 7, piece, a, b - a, zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes()), ids[a:b]))
    return out


@pytest.mark.parametrize("ranks", [None, path("byte_bpe_50k.tiktoken")])
def test_pieces_and_round_trip(spark, docs, ranks):
    pieces = token_pieces(docs, path("byte_bpe_50k.json"), ranks, PATTERN, with_ids=True)
    got = sorted(tuple(r) for r in pieces.collect())
    assert got == sorted(plain_pieces())
    packed = pack(pieces).cache()
    sequences = {r["sequence_id"]: r["ids"] for r in packed_sequences(packed).collect()}
    for r in packed.collect():
        assert sequences[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]] == r["ids"]
    assert max(map(len, sequences.values())) <= 2048
    assert sum(map(len, sequences.values())) == sum(len(p[5]) for p in plain_pieces())


CAPACITIES = [
    Capacity(),
    Capacity(documents=3),
    Capacity(attention=1024 * 1024),
    Capacity(documents=5, attention=900_000, weights=(1.0, 0.2, 3.0)),
    Capacity(tokens=4096, documents=4, weights=(0.5, 1.0, 0.25)),
]


def plain_best_fit(lengths, cap, score):
    """Sequences as lists of lengths, longest pieces first, each where least is left by the score."""
    full, made = (cap.tokens, cap.documents, cap.attention), []
    for n in sorted(lengths, reverse=True):
        need, best = (n, 1, n * n), None
        for bin_ in made:
            rest = [f - u - x for f, u, x in zip(full, (sum(bin_), len(bin_), sum(m * m for m in bin_)), need)]
            if min(rest) >= 0:
                left = [r / f for r, f in zip(rest, full)]
                points = sum(w * a * (a if score == "norm" else x / f) for w, a, x, f in zip(cap.weights, left, need, full))
                if best is None or points < best[0] - 1e-12:
                    best = (points, bin_)
        if best is None:
            made.append([n])
        else:
            best[1].append(n)
    return made


@pytest.mark.parametrize("score", ["dot", "norm"])
@pytest.mark.parametrize("cap", CAPACITIES)
def test_every_capacity_holds_and_few_sequences_are_made(score, cap):
    lengths = np.random.default_rng(1).integers(1, cap.piece + 1 if cap.documents > 10 else 500, 3000)
    seq, off = best_fit(lengths, cap, score)
    fullest = [0, 0, 0]
    for s in np.unique(seq):
        mine = np.flatnonzero(seq == s)
        n, order = lengths[mine], np.argsort(off[mine])
        assert n.sum() <= cap.tokens and len(n) <= cap.documents and (n**2).sum() <= cap.attention
        assert (off[mine][order] == np.concatenate([[0], np.cumsum(n[order])[:-1]])).all()
        fullest = [max(a, b) for a, b in zip(fullest, (n.sum() / cap.tokens, len(n) / cap.documents, (n**2).sum() / cap.attention))]
    assert max(fullest) > 0.99
    if cap.documents < 10 or cap.attention < cap.tokens**2:  # tokens alone would have taken fewer sequences
        assert max(fullest[1:]) > 0.99 and len(np.unique(seq)) > 1.05 * len(np.unique(best_fit(lengths, Capacity(tokens=cap.tokens, attention=cap.tokens**2), score)[0]))
    if cap == Capacity():
        assert len(np.unique(seq)) <= 1.01 * lengths.sum() / 2048 + 1


@pytest.mark.parametrize("score", ["dot", "norm"])
@pytest.mark.parametrize("cap", CAPACITIES)
def test_choices_are_those_of_plain_best_fit(score, cap):
    lengths = np.random.default_rng(7).integers(1, cap.piece + 1, 250)
    seq, _ = best_fit(lengths, cap, score)
    got = sorted(sorted(lengths[seq == s].tolist()) for s in np.unique(seq))
    assert got == sorted(sorted(b) for b in plain_best_fit(lengths.tolist(), cap, score))


def test_weights_change_the_choice():
    lengths = np.random.default_rng(3).integers(1, 1000, 2000)
    seq = [best_fit(lengths, Capacity(documents=4, attention=1_500_000, weights=w), "dot")[0] for w in ((1, 1, 1), (0, 0, 1))]
    assert (seq[0] != seq[1]).any()


def test_piece_follows_from_the_capacities(spark, docs):
    cap = Capacity(tokens=2048, attention=600 * 600)
    assert cap.piece == 600
    pieces = token_pieces(docs, path("byte_bpe_50k.json"), size=cap.piece)
    made = pack(pieces, cap).collect()
    sums = {}
    for r in made:
        sums.setdefault(r["sequence_id"], []).append(r["length"])
    assert max(sum(n * n for n in ns) for ns in sums.values()) <= 600 * 600 and max(r["length"] for r in made) == 600
    with pytest.raises(Exception, match="larger than a sequence"):
        pack(token_pieces(docs, path("byte_bpe_50k.json")), cap).collect()


def test_too_large_a_piece_and_empty_table(spark, docs):
    with pytest.raises(ValueError):
        best_fit(np.array([5000]), Capacity(), "dot")
    pieces = token_pieces(docs.limit(0), path("byte_bpe_50k.json"))
    assert pack(pieces).collect() == []
    with pytest.raises(ValueError):
        pack(pieces, score="none")


def test_blocks_waste_little(spark):
    rows = [(i, 0, 0, int(n), 0) for i, n in enumerate(np.random.default_rng(2).integers(1, 2000, 4000))]
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
    made = pack(pieces, block=1000).select("sequence_id").distinct().count()
    assert made <= sum(r[3] for r in rows) / 2048 * 1.02 + 4
