"""Problem 5: what looks the same becomes equal, what looks different doesn't."""

import random
import unicodedata

import pytest

from parley.functions.glyphs import TO_LATIN
from parley.llm import confusables

SAME = [
    ("plan", "ｐｌａｎ"), ("Ofice", "Οfice"), ("efficiency", "eﬃciency"), ("Açora", "Ас̧ora"), ("Tönis", "Tönis"), ("co-op", "co‐op"), ("co-op", "co‑op"), ("a b", "a b"), ("a b", "a b"),
    ("FY28", "FY­28"), ("stage", "st​age"), ("stage", "sta͏ge"), ("stage︎", "stage"), ("Мирта", "Mирта"), ("ＴＨＥ", "ΤНЕ"), ("K", "K"), ("१२", "१‍२"), ("sarex", "ѕаrех"), ("ё", "ё"),
]
DIFFERENT = [("plan", "Plan"), ("Zurel", "Zürel"), ("28", "29"), ("a b", "ab"), ("m2", "m²"), ("Δ", "A"), ("β", "B"), ("Мирта", "Mirta"), ("a-b", "a–b"), ("co op", "co-op"), ("5-6", "5−6"), ("I", "l")]


@pytest.mark.parametrize("a,b", SAME)
def test_same(a, b):
    n = confusables.Normalizer()
    assert n(a)[0] == n(b)[0]


@pytest.mark.parametrize("a,b", DIFFERENT)
def test_different(a, b):
    n = confusables.Normalizer()
    assert n(a)[0] != n(b)[0]


def test_kinds_and_stability():
    n = confusables.Normalizer()
    assert n("thе plan") == ("the plan", 1, 0) and n("сарех plan") == ("capex plan", 0, 1) and n("Мирта") == ("Мирта", 0, 0) and n("Mирта") == ("Мирта", 1, 0)
    for a, b in SAME:
        assert n(n(b)[0])[0] == n(b)[0]


def test_random_disguises():
    rng = random.Random(2)
    back = {}
    for m in TO_LATIN.values():
        for k, v in m.items():
            back.setdefault(v, []).append(k)
    n = confusables.Normalizer()
    for _ in range(200):
        plain = "".join(rng.choice("abcdefghijop ABCEHKMOPTXéüñ-12") for _ in range(30))
        plain = unicodedata.normalize("NFC", plain)
        out = []
        for c in plain:
            r = rng.random()
            if c in back and r < 0.3:
                c = rng.choice(back[c])
            elif c.isascii() and c.isalnum() and r < 0.4:
                c = chr(ord(c) + 0xFEE0)
            elif r > 0.9:
                c += rng.choice("​­⁠﻿͏")
            out.append(c)
        assert n("".join(out))[0] == n(plain)[0]


def test_pairs(spark):
    rows = [(1, "the plan", "x"), (2, "the plan", "x"), (3, "thе plan", "x"), (4, "the plan", "x"), (5, "The plan", "x"), (6, None, None), (7, "", None), (None, "ｔｈｅ plan", None), (8, "​", None), (9, "ａ" * 300_000, None), (10, "a" * 300_000, None)]
    df = spark.createDataFrame(rows, "guidance_id long, passage string, form string")
    got = {tuple(r) for r in confusables.lookalike_pairs(df, "guidance_id", "passage").collect()}
    assert got == {(1, 2), (1, 3), (2, 3), (2, 4), (3, 4), (7, 8), (9, 10)}
    assert confusables.lookalike_pairs(df.limit(0), "guidance_id", "passage").count() == 0
    forms = {r["guidance_id"]: r["form"] for r in confusables.forms(df, ["guidance_id"], "passage").collect()}
    assert len(forms) == 11 and forms[6] is None and forms[7] == forms[8] == "" and forms[3] == forms[1] == forms[None] and forms[9] == forms[10]
