"""Problem 3 - quantities in different units, brought to the common unit of their kind.

Method: numbers and unit expressions are parsed with a grammar, a unit is an
exponent vector over base dimensions with a scale (and an offset), and an amount
becomes amount x scale + offset in the canonical unit.

    amount   := bound? currency? number unit? ((- | to) bound? currency? number unit?)?
    unit     := factor+ (per factor+)*
    factor   := scale word | unit word | currency
    per      := '/' | 'per' | 'a' before a unit of time or mass | 'monthly' | 'p.a.' | ...

The canonical scale of a kind comes from the table of units itself: its unit codes
are parsed by the same grammar, so a row's factor fixes the conversion of its kind.
Currencies other than the rupee are converted by a join with the rates of the
item's quarter.

The unit is read from guidance_value, then from guidance_unit, then from the place
in the passage where the same number stands; the currency likewise, with the
currency column before the passage. Amounts in crore or lakh are in rupees.

Defined results: null and empty values, words without a number, multiples, and
numbers whose unit is told nowhere or has no kind in the table give no row in
`quantities`. A foreign amount without a rate gives null lo and hi, an amount beyond
10^18 likewise. Repeated rows are kept. Ranges told high to low are put in order.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.glyphs import fold

#: Base dimensions and their base units: currency unit, kilogram, month, kilowatt, basis point, multiple, kelvin.
DIMENSIONS = ("money", "mass", "time", "power", "ratio", "multiple", "temperature")

# Words of unit expressions, as (dimension, scale) in base units.
UNITS = {
    "mass": {"kg": 1, "kgs": 1, "kilo": 1, "kilos": 1, "kilogram": 1, "kilograms": 1, "quintal": 100, "quintals": 100, "qtl": 100, "qtls": 100, "ton": 1000, "tons": 1000, "tonne": 1000, "tonnes": 1000, "mt": 1000, "kt": 10**6, "kilotonne": 10**6, "kilotonnes": 10**6, "mmt": 10**9},
    "time": {"month": 1, "months": 1, "mth": 1, "mths": 1, "quarter": 3, "quarters": 3, "qtr": 3, "qtrs": 3, "year": 12, "years": 12, "yr": 12, "yrs": 12, "annum": 12},
    "power": {"kw": 1, "kilowatt": 1, "kilowatts": 1, "mw": 1000, "megawatt": 1000, "megawatts": 1000, "gw": 10**6, "gigawatt": 10**6, "gigawatts": 10**6},
    "ratio": {"%": 100, "percent": 100, "pct": 100, "%age": 100, "percentage": 100, "bps": 1, "bp": 1},
    "multiple": {"x": 1, "times": 1, "fold": 1},
    "temperature": {"k": 1, "kelvin": 1, "celsius": 1},
}
OFFSETS = {"celsius": Fraction("273.15")}
SCALES = {"thousand": 10**3, "thousands": 10**3, "'000": 10**3, "lakh": 10**5, "lakhs": 10**5, "lac": 10**5, "lacs": 10**5, "million": 10**6, "millions": 10**6, "mn": 10**6, "mio": 10**6, "crore": 10**7, "crores": 10**7, "cr": 10**7, "crs": 10**7, "billion": 10**9, "billions": 10**9, "bn": 10**9}
RUPEE_SCALES = frozenset(("lakh", "lakhs", "lac", "lacs", "crore", "crores", "cr", "crs"))
CURRENCIES = {"inr": "INR", "rs": "INR", "₹": "INR", "rupee": "INR", "rupees": "INR", "usd": "USD", "us$": "USD", "$": "USD", "dollar": "USD", "dollars": "USD"}
RATES = {"p.a": ("time", -1, 12), "pa": ("time", -1, 12), "annually": ("time", -1, 12), "yearly": ("time", -1, 12), "monthly": ("time", -1, 1), "pm": ("time", -1, 1)}
SHORT = {"tpa": ("ton", "p.a"), "tpm": ("ton", "monthly"), "ktpa": ("kt", "p.a"), "mtpa": ("million", "ton", "p.a"), "mmtpa": ("million", "ton", "p.a")}
UNKNOWN = frozenset(("", "n/a", "na", "-", "--", "none", "nil", "null", "unknown"))

_WORD = re.compile(r"\s*(us\$|'000|%age|%|₹|\$|/|p\.\s?a(?:\.|\b)|per\s?cent\b|basis\s+points?\b|metric\s+tons?\b|metric\s+tonnes?\b|[a-z]+\.?)")
_NUMBER = re.compile(r"(?<![\w.,'])(\d[\d,]*(?:\.\d+)?|\.\d+)(?![\d])")
_RANGE = re.compile(r"\s*(?:-|–|—|\bto\b|\band\b)\s*")


@dataclass(frozen=True)
class Unit:
    """Exponents of the dimensions, scale and offset to base units, currency, and whether a scale word was read."""

    exponents: tuple[int, ...] = (0,) * len(DIMENSIONS)
    scale: Fraction = Fraction(1)
    offset: Fraction = Fraction(0)
    currency: str | None = None
    scaled: bool = False
    rupees: bool = False

    def has(self, dimension: str) -> int:
        return self.exponents[DIMENSIONS.index(dimension)]

    @property
    def empty(self) -> bool:
        return not any(self.exponents)


def parse_unit(text: str, leading: bool = False, at: int = 0) -> tuple[Unit | None, int]:
    """The unit a text in lower case spells from position `at` on, and where it ends.

    leading: read the longest unit there and leave the rest; otherwise a
    word that belongs to no unit makes the text no unit.
    """
    exponents = dict.fromkeys(DIMENSIONS, 0)
    scale, offset, currency, scaled, rupees = Fraction(1), Fraction(0), None, False, False
    sign, end, read = 1, at, 0

    time_scale = Fraction(1)

    def add(dimension: str, power: int, size: int | Fraction) -> None:
        nonlocal scale, time_scale
        exponents[dimension] += power
        if dimension == "time":
            time_scale *= Fraction(size) ** power
        else:
            scale *= Fraction(size) ** power

    while m := _WORD.match(text, at):
        raw = re.sub(r"\s+", " ", m.group(1))
        w = raw.rstrip(".") if raw != "." else raw
        w = {"per cent": "percent", "percent": "percent", "basis point": "bp", "basis points": "bps", "p. a": "p.a"}.get(w, w)
        if w.startswith("metric t"):
            w = "ton"
        at = m.end()
        if w in ("/", "per") or w == "a" and read and (n := _WORD.match(text, at)) and any(n.group(1).rstrip(".") in UNITS[d] for d in ("time", "mass")):
            sign = -1
            read += w != "a"
            continue
        if w in RATES:
            dimension, power, size = RATES[w]
            add(dimension, power, size)
        elif w in SHORT:
            inner, _ = parse_unit(" ".join(SHORT[w]))
            for d, e in zip(DIMENSIONS, inner.exponents):
                exponents[d] += e * sign
            scale *= inner.scale**sign  # holds the scale of its time, too
        elif w in CURRENCIES:
            if currency is None:
                exponents["money"] += sign
            currency = currency or CURRENCIES[w]
        elif w in SCALES:
            scale *= Fraction(SCALES[w]) ** sign
            scaled, rupees = True, rupees or w in RUPEE_SCALES
        else:
            dimension = next((d for d, words in UNITS.items() if w in words), None)
            if dimension is None:
                if leading:
                    break
                return None, 0
            add(dimension, sign, UNITS[dimension][w])
            offset = OFFSETS.get(w, offset)
        read += 1
        end = at
        if sign < 0 and w not in SCALES:
            sign = 1
    if not leading and text[at:].strip(" .,;:()"):
        return None, 0
    if not read:
        return None, 0
    if exponents["ratio"]:
        exponents["time"] = 0  # a share a year is a share
    else:
        scale *= time_scale
    vector = tuple(exponents[d] for d in DIMENSIONS)
    if not any(vector) and scaled:
        vector = (1, *vector[1:])  # a bare scale counts money
    elif exponents["mass"] == -1 and not exponents["money"]:
        vector = (1, *vector[1:])  # 'per ton' is a price
    return Unit(vector, scale, offset, currency, scaled, rupees), end


def conversions(rows: list[tuple[str, str, str, object]]) -> dict[tuple[int, ...], tuple[str, Fraction]]:
    """vector -> (common unit, factor from base units), from rows (unit_code, quantity_kind, common_unit, factor)."""
    out: dict[tuple[int, ...], tuple[str, Fraction]] = {}
    for code, _, common, factor in rows:
        unit, _ = parse_unit(code.replace("_", " ").lower())
        if unit is None or factor is None:
            continue
        per_base = Fraction(str(factor)) / unit.scale
        known = out.setdefault(unit.exponents, (common, per_base))
        if known != (common, per_base):
            raise ValueError(f"{code}: its factor doesn't fit the other units of its kind")
    return out


def number(text: str) -> Fraction:
    return Fraction(text.replace(",", ""))


def parse_amount(value: str) -> tuple[Fraction, Fraction, str] | None:
    """(first, second, text of the unit) of a value in lower case; None without a number."""
    clean = re.sub(r"'000", " thousand ", value)
    found = list(_NUMBER.finditer(clean))
    if not found:
        return None
    first = found[0]
    last = first
    before = clean[: first.start()]
    after = clean[first.end() :]
    if len(found) > 1:
        between = clean[first.end() : found[1].start()]
        sep = re.search(r"-|–|—|\bto\b|\band\b", between)
        if sep:
            last = found[1]
            after = clean[last.end() :]
            if not re.sub(r"[^a-z%₹$/]", "", after):
                after = between[: sep.start()]
    a, b = number(first.group(1)), number(last.group(1))
    if re.search(r"(?:^|[\s(₹$])[-−]\s*$", before) and last is first:
        a = b = -a
    words = re.sub(r"\b(?:approx(?:imately)?|around|about|nearly|almost|roughly|close to|circa|ca|up ?to|at ?least|at ?most|more than|less than|over|under|above|below|minimum|maximum|min|max|of|between|from|to)\b\.?|[<>=≤≥~+±≈-]", " ", before)
    return a, b, f"{words.strip()} {after.strip()}".strip()


# Words of metric names and the dimension their amounts have.
METRIC_DIMENSIONS = {"pct": "ratio", "growth": "ratio", "margin": "ratio", "absolute": "money", "period": "time", "payback": "time", "timeline": "time", "capacity": "mass", "volume": "mass", "tons": "mass", "ton": "mass", "power": "power"}


def hint_of(metric: str | None) -> str | None:
    """The dimension a metric's name speaks of, its last word first."""
    return next((METRIC_DIMENSIONS[w] for w in reversed(re.findall(r"[a-z]+", (metric or "").lower())) if w in METRIC_DIMENSIONS), None)


def in_passage(passage: str, low: Fraction, high: Fraction, vectors: set[tuple[int, ...]], hint: str | None = None) -> Unit | None:
    """The unit written with the same number, or the same range, in a passage in lower case.

    Where the number stands in several places, those of a known kind come first, then those of the hinted dimension, then the earlier.
    """
    hits: list[tuple[tuple[bool, bool], Unit]] = []
    numbers = list(_NUMBER.finditer(passage))
    for i, m in enumerate(numbers):
        if number(m.group(1)) != low:
            continue
        first_unit = None
        unit, _ = parse_unit(passage, True, m.end())
        if high != low:
            if i + 1 == len(numbers) or number(numbers[i + 1].group(1)) != high:
                continue
            between = passage[m.end() : numbers[i + 1].start()]
            if not re.search(r"-|–|—|\bto\b|\band\b", between):
                continue
            first_unit, end = unit, numbers[i + 1].end()
            unit, _ = parse_unit(passage, True, end)
        unit = unit or first_unit
        sign = re.search(r"(us\$|\$|₹|\brs\.?|\binr|\busd)\s*$", passage[: m.start()])
        if sign:
            currency = CURRENCIES[sign.group(1).rstrip(".")]
            unit = Unit((1, *(unit or Unit()).exponents[1:]), unit.scale if unit else Fraction(1), Fraction(0), currency, bool(unit and unit.scaled), bool(unit and unit.rupees))
        if unit and not unit.empty:
            hits.append(((unit.exponents not in vectors, bool(hint) and not unit.has(hint)), unit))
    return min(hits, key=lambda h: h[0])[1] if hits else None


def common_amount(value: str | None, unit: str | None, currency: str | None, passage: str | None, metric: str | None, kinds: dict[tuple[int, ...], tuple[str, Fraction]]) -> tuple[str, Decimal | None, Decimal | None, str] | None:
    """(common unit, lo, hi, currency) before the conversion of the currency; None if it is no amount of a known kind."""
    if not value:
        return None
    amount = parse_amount(fold(value).lower())
    if amount is None:
        return None
    low, high, words = amount
    own, _ = parse_unit(words) if words else (None, 0)
    if own is None and words:
        own, _ = parse_unit(words, leading=True)
    column = fold(unit or "").strip().lower()
    field = None if column in UNKNOWN else parse_unit(column)[0]
    told = CURRENCIES.get((currency or "").strip().lower())
    if own and field and own.has("money") == 1 and not own.scaled and field.has("money") == 1:
        own = Unit(field.exponents, field.scale, field.offset, own.currency or field.currency, field.scaled, field.rupees)
    chosen = own if own and not own.empty else field if field and not field.empty else None
    text = fold(passage or "").lower()
    if chosen is None or chosen.has("money") == 1 and not chosen.scaled and not chosen.has("mass") and own is not None and field is None:
        found = in_passage(text, low, high, set(kinds), hint_of(metric))
        chosen = found or chosen
    if chosen is None:
        return None
    known = kinds.get(chosen.exponents)
    if known is None:
        return None
    money = "INR"
    if chosen.has("money"):
        money = "INR" if chosen.rupees else chosen.currency or told
        if money is None:
            beside = in_passage(text, low, high, set(kinds), hint_of(metric))
            money = beside.currency if beside and beside.currency and not beside.rupees else "INR"
    common, per_base = known
    lo, hi = sorted(((x * chosen.scale + chosen.offset) * per_base for x in (low, high)))
    if max(-lo, hi) >= 10**18:
        return common, None, None, money
    as_decimal = lambda f: (Decimal(f.numerator) / Decimal(f.denominator)).quantize(Decimal("0.000001"))
    return common, as_decimal(lo), as_decimal(hi), money


def quantities(items: DataFrame, units: DataFrame, rates: DataFrame, key: str = "guidance_id") -> DataFrame:
    """(key, common_unit, lo, hi, currency) of every item that holds an amount of a kind of the table `units`.

    `units` is a fixed table with one row for each unit; it is read on the driver. `rates`
    has one row for each currency and quarter.
    """
    kinds = conversions([tuple(r) for r in units.select("unit_code", "quantity_kind", "common_unit", "factor").collect()])

    told = ("guidance_value", "guidance_unit", "currency", "passage", "metric")
    own = items.where("guidance_value is not null").select(F.col(key).alias("__key"), F.upper(F.trim("quarter")).alias("__q"), *told)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        amount = pa.decimal128(32, 6)
        for batch in batches:
            found = [(i, a) for i, row in enumerate(zip(*(batch.column(2 + k).to_pylist() for k in range(len(told))))) if (a := common_amount(*row, kinds))]
            take = pa.array([i for i, _ in found], pa.int64())
            made = [pa.array([a[k] for _, a in found], t) for k, t in enumerate((pa.string(), amount, amount, pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), *made], ["__key", "__q", "common_unit", "lo", "hi", "currency"])

    # rows without an amount end here, and every row is parsed once
    rows = own.mapInArrow(parse, f"__key {own.schema['__key'].dataType.simpleString()}, __q string, common_unit string, lo decimal(32,6), hi decimal(32,6), currency string")
    fx = rates.select(F.col("currency").alias("__c"), F.upper(F.trim("quarter")).alias("__fq"), F.col("inr_per_unit").cast("decimal(14,6)").alias("__rate"))
    rows = rows.join(fx, (F.col("currency") == F.col("__c")) & (F.col("__q") == F.col("__fq")), "left")
    rate = F.when(F.col("currency") == "INR", F.lit(1).cast("decimal(14,6)")).otherwise(F.col("__rate"))
    whole = lambda c: F.round(F.col(c) * rate, 0).cast("bigint")
    return rows.select(F.col("__key").alias(key), "common_unit", whole("lo").alias("lo"), whole("hi").alias("hi"), "currency")
