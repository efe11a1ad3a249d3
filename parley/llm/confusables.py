"""Problem 5 - one form for texts that look the same.

Method: the letters of a token each carry the set of scripts in which their
glyph can be written; the sets are intersected over the token. A token whose
letters come from several scripts is a mixed-script confusable, one from a
single other script that can be written wholly in Latin is a whole-script
confusable; both get the spelling of one consistent script. Width forms, joined
letters, accents, spaces, hyphens and characters without a glyph are then
normalised. Case, accents, digits and wording stay as they are.

Defined results: null stays null, an empty text stays empty. A token that no
single script can write keeps its letters apart from look-alikes, which become
Latin. Repeated rows are kept. In `lookalike_pairs` rows with a null id or text
are in no pair.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.glyphs import FROM_LATIN, TO_LATIN, plain_characters, script_of
from ..session import cut, merge_join

#: Preferred script where a token can be written in several.
PREFERENCE = ("Latin", "Cyrillic", "Greek", "Armenian", "Cherokee", "Coptic")
_TOKEN = re.compile(r"(?:[^\W\d_][̀-ͯ]*)+")
_CACHE_LIMIT = 200_000


def scripts_for(ch: str) -> frozenset[str] | None:
    """Scripts that have a letter with this glyph; None: every script."""
    own = script_of(ch)
    if own is None:
        return None
    latin = TO_LATIN.get(own, {}).get(ch) if own != "Latin" else ch
    found = {own}
    if latin is not None:
        found.add("Latin")
        found |= {script for script, letters in FROM_LATIN.items() if latin in letters}
    return frozenset(found)


def respell(token: str) -> tuple[str, str]:
    """The consistent spelling of a decomposed token, and its kind: '', 'mixed' or 'whole'."""
    if token.isascii():
        return token, ""
    letters = [c for c in token if script_of(c)]
    own = {script_of(c) for c in letters}
    common: frozenset[str] | None = None
    for c in letters:
        s = scripts_for(c)
        common = s if common is None else common & s
    target = next((s for s in PREFERENCE if common and s in common), None)
    if own <= {"Latin"} and not any(c in TO_LATIN["Latin"] for c in token):
        return token, ""
    out = []
    for c in token:
        script = script_of(c)
        latin = TO_LATIN.get(script, {}).get(c, c if script == "Latin" else None)
        if script is None or latin is None or script == target != "Latin":
            out.append(c)
        elif target in (None, "Latin"):
            out.append(latin)
        else:
            out.append(FROM_LATIN[target].get(latin, c))
    spelled = "".join(out)
    return spelled, "mixed" if len(own) > 1 else "whole" if spelled != token else ""


class Normalizer:
    """Normalises texts; keeps the spelling of tokens it has seen."""

    def __init__(self) -> None:
        self.seen: dict[str, tuple[str, str]] = {}

    def __call__(self, text: str) -> tuple[str, int, int]:
        """The form, and the number of mixed and of whole-script confusable tokens."""
        if text.isascii() and text.isprintable():
            return text, 0, 0
        plain = unicodedata.normalize("NFD", text).translate(plain_characters())
        counts = {"": 0, "mixed": 0, "whole": 0}

        def spell(m: re.Match[str]) -> str:
            token = m.group()
            if token.isascii():
                return token
            known = self.seen.get(token)
            if known is None:
                if len(self.seen) > _CACHE_LIMIT:
                    self.seen.clear()
                known = self.seen[token] = respell(token)
            counts[known[1]] += 1
            return known[0]

        form = plain if plain.isascii() else unicodedata.normalize("NFC", _TOKEN.sub(spell, plain))
        return form, counts["mixed"], counts["whole"]


def forms(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys, form, mixed_tokens, whole_tokens) of every row; a text of printable ASCII characters is its own form and never reaches Python."""
    rows = df.select(*keys, F.col(text).alias("__text"))
    plain = F.col("__text").isNull() | F.col("__text").rlike(r"\A[\x20-\x7e]*\z")
    zero = F.when(F.col("__text").isNotNull(), F.lit(0))
    own = rows.where(plain).select(*keys, F.col("__text").alias("form"), zero.alias("mixed_tokens"), zero.alias("whole_tokens"))
    kinds = dict(rows.dtypes)

    def normalise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = Normalizer()
        for batch in batches:
            found = [one(t) for t in batch.column(len(keys)).to_pylist()]
            made = [pa.array([f[k] for f in found], t) for k, t in enumerate((pa.string(), pa.int32(), pa.int32()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keys)], *made], [*keys, "form", "mixed_tokens", "whole_tokens"])

    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), "form string, mixed_tokens int, whole_tokens int"])
    return own.unionByName(rows.where(~plain).mapInArrow(normalise, schema))


def lookalike_pairs(df: DataFrame, key: str, text: str) -> DataFrame:
    """All pairs (a < b) of rows whose texts differ as strings and share one form.

    Distinct texts are paired first and ids attached after, so a group of exact
    copies, however large, never meets itself. Two texts of printable ASCII characters
    never share a form; so only the others are normalised, and meet each other and
    the text that equals their form. The joins carry hashes of 128 bits, no texts.
    """
    digest = lambda c: (F.xxhash64(c), F.xxhash64(F.lit("2"), c))
    named = lambda c, n: [x.alias(f"{n}{i}") for i, x in enumerate(digest(F.col(c)))]
    rows = df.select(F.col(key).alias("id"), F.col(text).alias("text")).where("id is not null and text is not null")
    ids = rows.select("id", *named("text", "h"))
    other = rows.where(~F.col("text").rlike(r"\A[\x20-\x7e]*\z")).select("text", *named("text", "h")).groupBy("h0", "h1").agg(F.min("text").alias("text"))
    variants = forms(other, ["h0", "h1"], "text").select("h0", "h1", *named("form", "f"))
    variants = cut(variants.unionByName(variants.select(F.col("f0").alias("h0"), F.col("f1").alias("h1"), "f0", "f1")).distinct())  # small beside the texts, and read for both sides
    side = lambda s: variants.select("f0", "f1", F.col("h0").alias(f"h0_{s}"), F.col("h1").alias(f"h1_{s}"))
    pairs = merge_join(side("l"), side("r"), ["f0", "f1"]).where("h0_l < h0_r or h0_l = h0_r and h1_l < h1_r")
    for s in "lr":
        pairs = merge_join(pairs, ids.select(F.col("id").alias(f"id_{s}"), F.col("h0").alias(f"h0_{s}"), F.col("h1").alias(f"h1_{s}")), [f"h0_{s}", f"h1_{s}"])
    return pairs.select(F.least("id_l", "id_r").alias("a"), F.greatest("id_l", "id_r").alias("b")).where("a < b")
