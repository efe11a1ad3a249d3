"""Problem 4 - pieces under a size limit, cut where the talk breaks, with overlap.

Method: pointer doubling. Every word position of a text is joined to its
farthest legal successor: the farthest break that keeps the piece, overlap
included, within the limit. Squaring the successor table and collecting what
the cuts found so far reach gives all greedy cuts of all texts of a batch
after log2(words) vector steps; no text is walked piece by piece.

A word is a longest run of characters other than space, tab, carriage return
and line feed. Breaks in order of preference: a paragraph break that leaves the
piece at least half full, the end of a sentence or line, any paragraph break, and
where none is in reach the limit itself.

Defined results: null and empty texts and texts within the limit give no
pieces here (`pieces` with whole=True returns them as one piece each; null and
blank texts as one piece with 0 words). Texts are never shortened. Repeated rows
keep their own pieces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_RUN = re.compile(r"[^ \t\r\n]+")
_STOP = re.compile(r"[.!?।][\"'»”’)\]]*$")
# Words with a full stop that end no sentence.
SHORT_FORMS = frozenset("rs. mr. mrs. ms. dr. approx. no. vs. co. ltd. p.a. e.g. i.e. etc. st. inc.".split())
#: Kinds of break, from none to strongest.
NONE, LINE, PARAGRAPH = 0, 1, 2


def words_and_breaks(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and the kind of break after it."""
    spans = [m.span() for m in _RUN.finditer(text)]
    if not spans:
        z = np.zeros(0, dtype=np.int64)
        return z, z, z.astype(np.int8)
    at = np.array(spans, dtype=np.int64)
    breaks = np.zeros(len(spans), dtype=np.int8)
    for i, (a, b) in enumerate(spans):
        nxt = spans[i + 1][0] if i + 1 < len(spans) else b
        if nxt - b > 1 or text[b : b + 1] in "\r\n":
            gap = text[b:nxt]
            if "\n" in gap or "\r" in gap:
                breaks[i] = PARAGRAPH if gap.replace("\r\n", "\n").replace("\r", "\n").count("\n") > 1 else LINE
        if not breaks[i] and text[b - 1] in ".!?।\"'»”’)]":
            w = text[a:b]
            if _STOP.search(w) and w.lower() not in SHORT_FORMS:
                breaks[i] = LINE
    return at[:, 0], at[:, 1], breaks


def successors(breaks: np.ndarray, limit: int, overlap: int) -> np.ndarray:
    """For every cut position 0..n its farthest legal successor. breaks: kind of break after each word."""
    n = len(breaks)
    cut = np.arange(n + 1)
    start = np.where(cut == 0, 0, np.maximum(cut - overlap, 0))
    reach = np.minimum(start + limit, n)
    after = np.concatenate([[NONE], breaks])  # kind of break before word i, that is at cut i
    last = {kind: np.maximum.accumulate(np.where(after >= kind, cut, -1)) for kind in (LINE, PARAGRAPH)}
    paragraph, line = last[PARAGRAPH][reach], last[LINE][reach]
    half = start + limit // 2
    best = np.where((paragraph > cut) & (paragraph >= half), paragraph, np.where(line > cut, line, reach))
    return np.where(reach >= n, n, best)


def reached(successor: np.ndarray, roots: np.ndarray) -> np.ndarray:
    """Mask of the positions on the paths from the roots, by squaring the successor table."""
    mask = np.zeros(len(successor), dtype=bool)
    mask[roots] = True
    table = successor
    while True:
        mask[table[mask]] = True
        squared = table[table]
        if (squared == table).all():
            return mask
        table = squared


def cut_texts(texts: list[str], limit: int, overlap: int) -> list[tuple[int, int, int, int, int, str, str]]:
    """Pieces of all texts as (text no, piece no, first word, words, kind...). All texts of a batch are cut at once."""
    spans = [words_and_breaks(t) for t in texts]
    sizes = np.array([len(s[0]) for s in spans], dtype=np.int64)
    base = np.concatenate([[0], np.cumsum(sizes + 1)])  # positions of text k: base[k] .. base[k] + n
    table = np.concatenate([successors(s[2], limit, overlap) + base[k] for k, s in enumerate(spans)])
    mask = reached(table, base[:-1])
    out = []
    for k, (starts, ends, breaks) in enumerate(spans):
        n = int(sizes[k])
        cuts = np.flatnonzero(mask[base[k] : base[k + 1]])
        cuts = cuts[cuts > 0]
        previous = 0
        for no, c in enumerate(cuts.tolist(), 1):
            first = max(previous - overlap, 0) if previous else 0
            kind = "end" if c == n else ("limit", "sentence", "paragraph")[int(breaks[c - 1])]
            out.append((k, no, first + 1, c - first, c, kind, texts[k][starts[first] : ends[c - 1]]))
            previous = c
    return out


def pieces(df: DataFrame, key: str, text: str, limit: int, overlap: int, whole: bool = False) -> DataFrame:
    """(key, piece_no, first_word, word_count, last_word, ends_at, text) of every text above the limit.

    A text of more than `limit` words has at least 2 * limit + 1 characters;
    shorter ones never reach Python. With whole=True every row is kept.
    """
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be at least 0 and smaller than limit")
    rows = df.select(F.col(key).alias("__key"), F.col(text).alias("__text"))
    large = F.coalesce(F.length("__text") > 2 * limit, F.lit(False))
    kind = rows.schema["__key"].dataType.simpleString()
    schema = f"`{key}` {kind}, piece_no int, first_word int, word_count int, last_word int, ends_at string, text string"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = [t or "" for t in batch.column(1).to_pylist()]
            found = [p for p in cut_texts(texts, limit, overlap)]
            many = {p[0] for p in found if p[1] > 1}
            if whole:
                cut_ = {p[0] for p in found}
                found += [(k, 1, 0, 0, 0, "end", "") for k in range(len(texts)) if k not in cut_]
            else:
                found = [p for p in found if p[0] in many]
            k, no, first, count, last, ends, piece = ([*x] for x in zip(*found)) if found else ([] for _ in range(7))
            keys = batch.column(0).take(pa.array(k, pa.int64()))
            yield pa.RecordBatch.from_arrays([keys, *(pa.array(x, pa.int32()) for x in (no, first, count, last)), pa.array(ends, pa.string()), pa.array(piece, pa.string())], [key, "piece_no", "first_word", "word_count", "last_word", "ends_at", "text"])

    return (rows if whole else rows.where(large)).mapInArrow(cut, schema)
