"""Characters that look the same: tables and the character-level fold.

Width forms and joined letters come from the Unicode data by rule; look-alike
letters of other scripts are a list of fixed values, taken from their shapes in
common text fonts: those a reader of running text can't tell from Latin letters.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

# Letters of other scripts and the Latin letters they look like.
LOOKALIKES = {
    "Cyrillic": ("АВЕЅІЈКМНОРСТУХҮԚԜԌӀѴаеѕіјорсухһԁԛԝӏүѵ", "ABESIJKMHOPCTYXYQWGIVaesijopcyxhdqwlyv"),
    "Greek": ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹͿοανιρυϲϳ", "ABEZHIKMNOPTYXCJoavipucj"),
    "Armenian": ("ՍՕոսօհցզ", "UOnuohgq"),
    "Cherokee": ("ᎠᎡᎢᎥᎪᎫᎬᎳᎷᎻᏀᏃᏏᏙᏚᏞᏟᏢᏦᏧᏴ", "DRTiAJEWMHGZbVSLCPKdB"),
    "Coptic": ("ⲀⲂⲈⲎⲒⲔⲘⲚⲞⲢⲤⲦⲬⲟⲣⲥ", "ABEHIKMNOPCTXopc"),
    "Latin": ("ɑɡ", "ag"),
}

# First and last code point of the scripts that take part.
SCRIPT_RANGES = {
    "Latin": ((0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0x2B8), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA722, 0xA7FF)),
    "Greek": ((0x370, 0x3FF), (0x1F00, 0x1FFF)),
    "Cyrillic": ((0x400, 0x52F), (0x1C80, 0x1C88), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)),
    "Armenian": ((0x531, 0x58F),),
    "Cherokee": ((0x13A0, 0x13FF), (0xAB70, 0xABBF)),
    "Coptic": ((0x2C80, 0x2CFF),),
    "Devanagari": ((0x900, 0x97F), (0xA8E0, 0xA8FF)),
}

#: script -> {letter: Latin letter}
TO_LATIN = {script: dict(zip(*pair)) for script, pair in LOOKALIKES.items()}
#: script -> {Latin letter: letter}
FROM_LATIN = {script: {v: k for k, v in reversed(m.items())} for script, m in TO_LATIN.items() if script != "Latin"}

# Hyphens that look like the ASCII one; dashes and the minus sign are longer to the eye.
HYPHENS = "‐‑˗⁃﹣－"
# Characters without a glyph that are not in the category Cf.
NO_GLYPH = [0x34F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x180B, 0x180C, 0x180D, 0x180F, 0x3164, 0xFFA0, *range(0xFE00, 0xFE10), *range(0xE0100, 0xE01F0)]


@cache
def plain_characters() -> dict[int, str | None]:
    """Translation of width and font forms, Roman numerals, joined letters, spaces, hyphens and characters without a glyph."""
    out: dict[int, str | None] = {}
    for code in range(0x80, 0x30000):
        ch = chr(code)
        kind = unicodedata.category(ch)
        if kind == "Zs":
            out[code] = " "
        elif kind == "Cf":
            out[code] = None
        else:
            shape = unicodedata.decomposition(ch)
            if shape.startswith(("<wide>", "<narrow>", "<font>")) or 0x2160 <= code <= 0x217F:
                out[code] = unicodedata.normalize("NFKC", ch)
            elif shape.startswith("<compat>") and kind in ("Ll", "Lu", "Lt") and len(shape.split()) > 2 and code < 0x250 or 0xFB00 <= code <= 0xFB17:
                out[code] = unicodedata.normalize("NFKC", ch)
    out |= {code: None for code in NO_GLYPH}
    out |= {ord(ch): "-" for ch in HYPHENS}
    out |= {code: None for code in (*range(0x09), 0x0B, 0x0C, *range(0x0E, 0x20), *range(0x7F, 0x85), *range(0x86, 0xA0))}
    return out


@cache
def script_of(ch: str) -> str | None:
    """Script of a letter; None for characters shared by all scripts."""
    code = ord(ch)
    for script, ranges in SCRIPT_RANGES.items():
        if any(a <= code <= b for a, b in ranges):
            return script
    return "Other" if unicodedata.category(ch).startswith("L") and sys.maxunicode else None


@cache
def _fold_table() -> dict[int, str | None]:
    t = dict(plain_characters())
    for pairs in TO_LATIN.values():
        t |= {ord(a): b for a, b in pairs.items()}
    return t


def fold(text: str) -> str:
    """Every look-alike letter as its Latin twin, other forms normalised: for reading a text, not for showing it."""
    return text if text.isascii() else unicodedata.normalize("NFC", unicodedata.normalize("NFD", text).translate(_fold_table()))

