"""Problem 4: every cut, against a walk piece by piece; exact round trips."""

import random
import re

import numpy as np
import pytest

from parley.llm import chunking

WORD = re.compile(r"[^ \t\r\n]+")


def text_of(n, seed):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        out.append(rng.choice(["word", "नमस्ते", "x" * rng.randint(1, 30), "Rs.", "end.", 'said."', "5%"]))
        out.append(rng.choice([" ", " ", " ", "  ", "\t", "\n", "\r\n", "\n\n", "\r\n \r\n"]))
    return "".join(out)


def walk(breaks, limit, overlap):
    """The greedy cuts one after the other."""
    cuts, at, n = [], 0, len(breaks)
    while at < n:
        start = max(0, at - overlap) if at else 0
        reach = min(start + limit, n)
        if reach == n:
            at = n
        else:
            inside = [c for c in range(at + 1, reach + 1)]
            strong = [c for c in inside if breaks[c - 1] == 2 and c >= start + limit // 2]
            any_ = [c for c in inside if breaks[c - 1] >= 1]
            at = strong[-1] if strong else any_[-1] if any_ else reach
        cuts.append(at)
    return cuts


@pytest.mark.parametrize("limit,overlap", [(600, 50), (10, 3), (5, 4), (7, 0), (2, 1)])
def test_cuts_equal_the_walk(limit, overlap):
    texts = [text_of(n, n) for n in (0, 1, limit, limit + 1, 3 * limit, 1500)]
    found = chunking.cut_texts(texts, limit, overlap)
    for k, t in enumerate(texts):
        _, _, breaks = chunking.words_and_breaks(t)
        assert [p[4] for p in found if p[0] == k] == walk(breaks.tolist(), limit, overlap)


def test_round_trip():
    t = text_of(5000, 9)
    words = WORD.findall(t)
    pieces = chunking.cut_texts([t], 600, 50)
    back = []
    for p in pieces:
        w = WORD.findall(p[6])
        assert len(w) == p[3] <= 600
        back += w if not back else w[50:]
    assert back == words
    for a, b in zip(pieces, pieces[1:]):
        assert WORD.findall(a[6])[-50:] == WORD.findall(b[6])[:50]


def test_squaring_reaches_everything():
    rng = np.random.default_rng(3)
    n = 1000
    table = np.minimum(np.arange(n) + rng.integers(1, 9, n), n - 1)
    at, path = 0, {0}
    while at != n - 1:
        at = int(table[at])
        path.add(at)
    assert set(np.flatnonzero(chunking.reached(table, np.array([0])))) == path


def test_rows(spark):
    long = "word " * 601
    rows = [(1, long, "t"), (1, long, "t"), (2, "word " * 600, "t"), (3, None, None), (4, "", None), (5, "x" * 300_000, None), (6, "a " * 100_000, None)]
    df = spark.createDataFrame(rows, "chunk_key long, text string, piece_no string")
    got = chunking.pieces(df, "chunk_key", "text", 600, 50)
    keys = sorted(r["chunk_key"] for r in got.where("piece_no = 1").collect())
    assert keys == [1, 1, 6]
    assert got.where("word_count > 600").count() == 0
    everything = chunking.pieces(df, "chunk_key", "text", 600, 50, whole=True)
    assert sorted(r["chunk_key"] for r in everything.where("piece_no = 1").collect()) == [1, 1, 2, 3, 4, 5, 6]
    assert chunking.pieces(df.limit(0), "chunk_key", "text", 600, 50).count() == 0
    with pytest.raises(ValueError):
        chunking.pieces(df, "chunk_key", "text", 50, 50)
