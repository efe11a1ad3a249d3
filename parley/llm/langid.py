"""Problem 8 - language labels for documents and for their segments.

Method: segmentation-marginalised unigrams. Every language owns a
distribution over the pieces of one fixed public vocabulary; a forward
algorithm sums the probability of *all* segmentations of a word into pieces,
and a text is the product of its words. The pieces of a word depend on nothing
outside it, so a worker scores each distinct word once and keeps the result.

A document is cut into units (sentences and lines). A hidden-state pass over
the units with a price for changing language joins units into segments, so a
fragment with little evidence (an abbreviation, a name) opens no segment.

Defined results: a null, empty or number-only text, or one that holds only
header lines, has no segment and no rows; its document row carries a null
language. Repeated rows are kept, each with its own segments. Columns of the
input other than the named ones are ignored, whatever they are called.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import merge_join

DEFAULT_VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"

#: States of the hidden-state pass. Hindi has one state for each script.
STATES = ("en", "hi_deva", "hi_latn", "de", "fr", "es", "pt")
LANG_OF = {s: s[:2] for s in STATES}
LANGS = ("en", "hi", "de", "fr", "es", "pt")

# Other notations of the labels.
NOTATIONS = {
    "en": ("en", "eng", "english"),
    "hi": ("hi", "hin", "hindi"),
    "de": ("de", "deu", "ger", "german", "deutsch"),
    "fr": ("fr", "fra", "fre", "french", "français", "francais"),
    "es": ("es", "spa", "spanish", "español", "espanol", "castilian"),
    "pt": ("pt", "por", "portuguese", "português", "portugues"),
}

_WORD = re.compile(r"[^\W\d_]+(?:[ऀ-ःऺ-ॏ̀-ͯ]+[^\W\d_]*)*")
_UNIT = re.compile(r"(?<=[.!?।])[\"'»”’)\]]*\s+|\s*[\r\n]+\s*")
_LABEL = re.compile(r"^\s*[\"'«“]?\s*[A-Z][\w'’-]*(?: [A-Z][\w'’.-]*){0,2}\s?:\s+")
_END = re.compile(r"[.!?।][\"'»”’)\]]*\s*$")
_DEVANAGARI = re.compile(r"[ऀ-ॿ]")


def canonical_label(col: Column) -> Column:
    """The language a label names in any notation ('pt-BR', 'ENG', 'German'); null where it names none."""
    base = F.regexp_extract(F.lower(F.trim(col)), r"^([^\s_-]+)", 1)
    known = [x for names in NOTATIONS.values() for x in names]
    pairs = F.create_map(*[F.lit(v) for k, names in NOTATIONS.items() for n in names for v in (n, k)])
    return F.when(base.isin(known), pairs[base])


def unaccented(text: str) -> str:
    """Latin letters without their accents; other scripts stay."""
    return "".join(c for c in unicodedata.normalize("NFD", text) if not "̀" <= c <= "ͯ")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


@dataclass
class PieceModel:
    """Per-language piece probabilities. `table` maps a piece to its row in `logp`."""

    table: dict[str, int]
    logp: np.ndarray  # pieces x states, natural logarithms
    longest: int
    clip: float = 6.0
    unknown: float = -14.0
    cache_limit: int = 400_000
    _ids: dict[str, int] = field(default_factory=dict, repr=False)
    _matrix: np.ndarray | None = field(default=None, repr=False)

    def __getstate__(self):
        return self.__dict__ | {"_ids": {}, "_matrix": None}

    def word(self, w: str) -> np.ndarray:
        """Log-probability of a word in every state, over all its segmentations."""
        s = "▁" + w
        n = len(s)
        at = [None] * (n + 1)
        at[0] = np.zeros(self.logp.shape[1])
        for end in range(1, n + 1):
            total = None
            for start in range(max(0, end - self.longest), end):
                row = self.table.get(s[start:end])
                if row is None:
                    if end - start > 1:
                        continue
                    step = at[start] + self.unknown
                else:
                    step = at[start] + self.logp[row]
                total = step if total is None else np.logaddexp(total, step)
            at[end] = total
        return at[n]

    def ids(self, words: list[str]) -> list[int]:
        """Rows of the word matrix. A word's row is kept for the life of the worker, up to cache_limit words."""
        known = self._ids
        out = [known.get(w, -1) for w in words]
        if -1 in out:
            for i, w in enumerate(words):
                if out[i] < 0:
                    if w not in known:
                        v = self.word(w)
                        at = known[w] = len(known)
                        if self._matrix is None:
                            self._matrix = np.empty((1024, len(v)), dtype=np.float32)
                        elif at == len(self._matrix):
                            self._matrix = np.concatenate([self._matrix, np.empty_like(self._matrix)])
                        self._matrix[at] = np.maximum(v - v.max(), -self.clip)  # one word decides nothing alone
                    out[i] = known[w]
        return out

    def matrix(self) -> np.ndarray:
        return self._matrix

    def make_room(self) -> None:
        if len(self._ids) > self.cache_limit:
            self._ids.clear()
            self._matrix = None


def load_vocabulary(path: str = DEFAULT_VOCABULARY) -> list[str]:
    """Pieces of the public vocabulary in their order, control and byte pieces left out."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]


def fit(samples: Iterable[tuple[str, str]], vocabulary: list[str], rounds: int = 6, background: float = 0.25) -> PieceModel:
    """Fit piece probabilities by expectation-maximisation over all segmentations.

    samples: (state, text). Each text counts as written and without accents.
    background: the share of a vocabulary-wide distribution mixed into each language.
    """
    table: dict[str, int] = {}
    for p in vocabulary:
        if p == p.lower() and p not in table:
            table[p] = len(table)
    longest = max(map(len, table))
    counts = [Counter() for _ in STATES]
    for state, text in samples:
        w = words_of(text)
        counts[STATES.index(state)].update(w)
        counts[STATES.index(state)].update(words_of(unaccented(text.lower())))
    rank = np.arange(1, len(table) + 1)
    base = 1.0 / (rank + 200.0)
    base /= base.sum()

    lattices: dict[str, list[list[tuple[int, int]]]] = {}

    def lattice(w: str) -> list[list[tuple[int, int]]]:
        if w not in lattices:
            s = "▁" + w
            lattices[w] = [[(a, table[s[a:b]]) for a in range(max(0, b - longest), b) if s[a:b] in table] for b in range(1, len(s) + 1)]
        return lattices[w]

    logp = np.tile(np.log(base)[:, None], (1, len(STATES)))
    unknown = 1e-7
    for k, words in enumerate(counts):
        p = base.copy()
        for _ in range(rounds):
            expected = np.zeros(len(table))
            for w, n in words.items():
                arcs = lattice(w)
                m = len(arcs)
                fwd = [1.0] + [0.0] * m
                for b in range(1, m + 1):
                    fwd[b] = sum(fwd[a] * p[i] for a, i in arcs[b - 1]) or fwd[b - 1] * unknown
                bwd = [0.0] * m + [1.0]
                for b in range(m, 0, -1):
                    if arcs[b - 1]:
                        for a, i in arcs[b - 1]:
                            bwd[a] += p[i] * bwd[b]
                    else:
                        bwd[b - 1] += unknown * bwd[b]
                for b in range(1, m + 1):
                    for a, i in arcs[b - 1]:
                        expected[i] += n * fwd[a] * p[i] * bwd[b] / max(fwd[m], 1e-300)
            total = expected.sum()
            p = (1 - background) * expected / total + background * base if total else base.copy()
        logp[:, k] = np.log(p)
    return PieceModel(table, logp, longest)


def state_of_sample(lang: str, text: str) -> str:
    if lang != "hi":
        return lang
    return "hi_deva" if _DEVANAGARI.search(text) else "hi_latn"


#: Words from which on a line without an end mark is a sentence; shorter ones are headers, titles and names.
SENTENCE_WORDS = 9


def units_of(text: str, sentence_words: int = SENTENCE_WORDS) -> list[str]:
    """Sentences and lines of a text that can carry a language: header lines, tables of numbers and bare names are left out.

    A sentence ends in an end mark or has `sentence_words` words or more.
    """
    out = []
    for u in _UNIT.split(text):
        if not u:
            continue
        u = _LABEL.sub("", u, count=1) if ":" in u else u
        if _END.search(u) or len(u.split()) >= sentence_words:
            out.append(u)
    return out


def decode(scores: np.ndarray, switch: float) -> np.ndarray:
    """Best state of each unit when every change of state costs `switch`."""
    n, k = scores.shape
    back = np.zeros((n, k), dtype=np.int64)
    best = scores[0].copy()
    own = np.arange(k)
    for i in range(1, n):
        top = int(best.argmax())
        moved = best[top] - switch
        stay = best >= moved
        back[i] = np.where(stay, own, top)
        best = np.where(stay, best, moved) + scores[i]
    path = np.empty(n, dtype=np.int64)
    path[-1] = int(best.argmax())
    for i in range(n - 1, 0, -1):
        path[i - 1] = back[i, path[i]]
    return path


_LANG_NO = np.array([LANGS.index(LANG_OF[s]) for s in STATES])


def segments_of(texts: list[str | None], model: PieceModel, switch: float = 9.0, sentence_words: int = SENTENCE_WORDS) -> list[list[tuple[str, float, int]]]:
    """For each text its segments as (lang, confidence, characters scored).

    The confidence is the probability of the language given the words of the segment, all
    languages being equally likely before.
    """
    docs: list[list[int]] = []  # per text the number of words of each unit
    sizes: list[list[int]] = []
    flat: list[str] = []
    for text in texts:
        lens: list[int] = []
        chars: list[int] = []
        for u in units_of(text, sentence_words) if text else ():
            w = words_of(u)
            if w:
                flat += w
                lens.append(len(w))
                chars.append(len(u))
        docs.append(lens)
        sizes.append(chars)
    if not flat:
        return [[] for _ in texts]
    ids = np.array(model.ids(flat), dtype=np.int64)
    ends = np.cumsum([n for lens in docs for n in lens])
    starts = np.concatenate([[0], ends[:-1]])
    scores = np.add.reduceat(model.matrix()[ids], starts, axis=0)
    lengths = ends - starts
    top = scores.argmax(axis=1)
    out = []
    at = 0
    for lens, chars in zip(docs, sizes):
        n = len(lens)
        if not n:
            out.append([])
            continue
        own = scores[at : at + n]
        langs = _LANG_NO[top[at : at + n]]
        if n > 1 and (langs != langs[0]).any():
            langs = _LANG_NO[decode(own.astype(np.float64), switch)]
        cuts = [0, *(np.flatnonzero(np.diff(langs)) + 1).tolist(), n]
        segments = []
        for a, b in zip(cuts, cuts[1:]):
            total = own[a:b].sum(axis=0)
            k = int(langs[a])
            e = np.exp(total - total.max())
            segments.append((LANGS[k], float(round(e[_LANG_NO == k].sum() / e.sum(), 6)), int(sum(chars[a:b]))))
        out.append(segments)
        at += n
    model.make_room()
    return out


# --- Spark ----------------------------------------------------------------------------------------

SWITCH = 6.0


def fit_model(samples: DataFrame, vocabulary: str = DEFAULT_VOCABULARY) -> PieceModel:
    """Fit on labelled samples (lang, text), a small fixed table that is read on the driver."""
    rows = samples.where("lang is not null and text is not null").select("lang", "text").collect()
    return fit([(state_of_sample(r["lang"], r["text"]), r["text"]) for r in rows if r["lang"] in LANGS], load_vocabulary(vocabulary))


def segments(documents: DataFrame, model: PieceModel, key: str = "doc_id", text: str = "text", label: str | None = "lang", switch: float = SWITCH, sentence_words: int = SENTENCE_WORDS) -> DataFrame:
    """(key, declared, segments, seg_no, lang, confidence, chars): one row for each segment of each document.

    declared: the language the label names, null if none; segments: their number in the document.
    """
    declared = canonical_label(F.col(label)) if label else F.lit(None).cast("string")
    rows = documents.select(F.col(key).alias("__key"), declared.alias("declared"), F.col(text).alias("__text"))
    kind = rows.schema["__key"].dataType.simpleString()
    shared = documents.sparkSession.sparkContext.broadcast(model)  # bounded by the vocabulary

    def run(batches):
        import pyarrow as pa

        own = shared.value
        for batch in batches:
            found = segments_of(batch.column(2).to_pylist(), own, switch, sentence_words)
            at = [i for i, s in enumerate(found) for _ in s]
            take = pa.array(at, pa.int64())
            flat = [(len(s), no, *x) for s in found for no, x in enumerate(s, 1)]
            n, no, lang, confidence, chars = ([*x] for x in zip(*flat)) if flat else ([] for _ in range(5))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array(n, pa.int32()), pa.array(no, pa.int32()), pa.array(lang, pa.string()), pa.array(confidence, pa.float64()), pa.array(chars, pa.int64())],
                [key, "declared", "segments", "seg_no", "lang", "confidence", "chars"],
            )

    return rows.mapInArrow(run, f"`{key}` {kind}, declared string, segments int, seg_no int, lang string, confidence double, chars bigint")


def wrong_or_mixed(found: DataFrame) -> DataFrame:
    """Segments of the documents whose label is missing or wrong or that hold several languages."""
    return found.where(F.col("declared").isNull() | (F.col("segments") > 1) | (F.col("declared") != F.col("lang")))


def documents_of(documents: DataFrame, found: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, lang, confidence, segments): one row for each key of `documents`, by the language that most of its characters are in.

    The confidence is that of its longest segment. Documents without a sentence have a null language and 0 segments.
    """
    by_lang = found.groupBy(F.col(key).alias("__k"), "lang").agg(F.sum("chars").alias("chars"), F.max(F.struct("chars", "confidence"))["confidence"].alias("confidence"), F.count("*").alias("n"))
    main = by_lang.groupBy("__k").agg(F.max(F.struct("chars", "lang", "confidence")).alias("m"), F.sum("n").alias("segments"))
    every = documents.select(key).distinct()
    rows = merge_join(every, main, F.col(key).eqNullSafe(F.col("__k")), "left")
    return rows.select(key, F.col("m.lang").alias("lang"), F.col("m.confidence").alias("confidence"), F.coalesce("segments", F.lit(0)).alias("segments"))
