"""Guidance values told as text. Column -> Column, no UDF; null where a text holds no value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.binding import let

NUMBER = r"\d+(?:\.\d+)?"
# The profit and loss metrics.
CREDIBLE = ("revenue_absolute", "revenue_growth_pct", "ebitda_margin_pct", "pat_absolute", "pat_growth_pct", "pbt_margin_pct", "eps_absolute")
#: Rupee crores above which a growth target is taken for a misreading.
ABSURD_CRORE = 500_000
# Signs and words of approximation before a value.
APPROXIMATE = r"(?i)^[~<>≈≤≥]+\s*|^(approximately|around|about|circa|nearly|roughly)\s+"
# Number words of time horizons.
NUMBER_WORDS = ("one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten")


def _double(c: Column) -> Column:
    return c.try_cast("double")  # null for an empty text


def bounds(value: Column, multiples: bool = False) -> Column:
    """struct(lo, hi): '18-20' -> (18, 20), '3,000' -> (3000, 3000), else nulls; the ends are not put in order.

    multiples: an 'x' of a multiple is dropped first ('2x' -> 2).
    """
    v = F.replace(F.replace(F.trim(value), F.lit(","), F.lit("")), F.lit("–"), F.lit("-"))
    if multiples:
        v = F.replace(v, F.lit("x"), F.lit(""))
    pattern = rf"^({NUMBER})(?:\s*-\s*({NUMBER}))?$"
    lo, hi = (_double(F.regexp_extract(v, pattern, g)) for g in (1, 2))
    return F.struct(lo.alias("lo"), F.coalesce(hi, lo).alias("hi"))


def midpoint(value: Column) -> Column:
    """Mean of a range or the number itself; a number with thousands separators has none."""
    v = F.replace(F.trim(value), F.lit("–"), F.lit("-"))
    pair = rf"^({NUMBER})\s*-\s*({NUMBER})$"
    a, b = (_double(F.regexp_extract(v, pair, g)) for g in (1, 2))
    return F.coalesce((a + b) / 2, F.when(~v.rlike(r"(?i)[a-z]"), v.try_cast("double")))


def spread(value: Column) -> Column:
    """struct(lo, hi) of the smallest and largest of the parts between dashes; nulls if a part is no number."""
    v = F.replace(F.replace(F.replace(F.trim(value), F.lit(","), F.lit("")), F.lit("–"), F.lit("-")), F.lit("x"), F.lit(""))
    parts = F.filter(F.split(v, "-"), lambda p: F.trim(p) != "")
    numbers = F.transform(parts, lambda p: F.trim(p).try_cast("double"))
    ok = (F.size(parts) > 0) & ~F.exists(numbers, lambda n: n.isNull())
    return F.struct(F.when(ok, F.array_min(numbers)).alias("lo"), F.when(ok, F.array_max(numbers)).alias("hi"))


def years_ahead(timeframe: Column, call_fy2: int = 24) -> Column:
    """struct(lo, hi) years of a horizon: fiscal years, 'next year', 'in 3 years', 'three to four years'.

    Of '2-3 years' only the number next to 'years' counts; four digits after 'FY' are no fiscal year.
    """
    t = F.replace(F.lower(timeframe), F.lit("–"), F.lit("-"))
    named = F.concat(
        F.transform(F.regexp_extract_all(t, F.lit(r"fy\s*'?(\d{2})\b"), F.lit(1)), lambda y: y.cast("int")),
        F.transform(F.regexp_extract_all(t, F.lit(r"\b(20\d{2})\b"), F.lit(1)), lambda y: y.cast("int") % 100),
    )
    ahead = F.transform(named, lambda y: F.greatest((y - call_fy2).cast("double"), F.lit(0.5)))
    digits = F.transform(F.regexp_extract_all(t, F.lit(r"\b(\d+(?:\.\d+)?)\s*(?:year|yr)"), F.lit(1)), lambda y: y.cast("double"))
    words = F.regexp_extract_all(t, F.lit(r"\b(" + "|".join(NUMBER_WORDS) + r")\b"), F.lit(1))
    spoken = F.transform(words, lambda w: F.array_position(F.array(*map(F.lit, NUMBER_WORDS)), w).cast("double"))
    none = F.array().cast("array<double>")
    chosen = (
        F.when(F.size(ahead) > 0, ahead)
        .when(t.contains("next year") | t.contains("next fiscal") | t.contains("coming year"), F.array(F.lit(1.0)))
        .when(F.size(digits) > 0, digits)
        .when((F.size(spoken) > 0) & (t.contains("year") | t.contains("yr")), spoken)
        .otherwise(none)
    )
    return F.struct(F.array_min(chosen).alias("lo"), F.array_max(chosen).alias("hi"))


def unit_word(unit: Column) -> Column:
    """A money unit in its plain form: 'Crs.' -> 'crore', 'mn' -> 'million'."""
    u = F.rtrim(F.trim(F.lower(F.coalesce(unit, F.lit("")))), F.lit("."))
    u = F.replace(F.replace(u, F.lit("mn"), F.lit("million")), F.lit("bn"), F.lit("billion"))
    return F.regexp_replace(F.regexp_replace(u, "^(?:crores|crs|cr)$", "crore"), "^(lakh|million|billion)s$", "$1")


def crore_factor(unit: Column, currency: Column, usdinr: Column) -> Column:
    """What turns an amount into rupee crores; 1 for percent, multiples and bare numbers, null for unknown units."""
    plain = {"": 1.0, "%": 1.0, "times": 1.0}
    crores = {"crore": 1.0, "lakh": 0.01, "million": 0.1, "billion": 100.0}
    usd = F.upper(F.coalesce(currency, F.lit(""))) == "USD"
    factors = F.create_map(*[F.lit(x) for pair in {**crores, **plain}.items() for x in pair])
    return let(unit_word(unit), lambda u: F.try_element_at(factors, u) * F.when(usd & u.isin(*crores), usdinr).otherwise(F.lit(1.0)))


def to_crore(value: Column, unit: Column, currency: Column, usdinr: Column) -> Column:
    """Rupee crores of an amount; percent, multiples and bare numbers pass as they are, unknown units give null."""
    return value * crore_factor(unit, currency, usdinr)


def rough_crore(value: Column, unit: Column, currency: Column, usdinr: float = 83.0) -> Column:
    """Magnitude in rupee crores for a sanity check; lakhs and crores are rupees."""
    u = F.replace(F.replace(F.lower(unit), F.lit("mn"), F.lit("million")), F.lit("bn"), F.lit("billion"))
    usd = F.upper(F.coalesce(currency, F.lit(""))) == "USD"
    return (
        F.when(u.isin("crore", "cr"), value)
        .when(u == "lakh", value * 0.01)
        .when(u == "million", value * F.when(usd, F.lit(usdinr / 10)).otherwise(F.lit(0.1)))
        .when(u == "billion", value * F.when(usd, F.lit(usdinr * 100)).otherwise(F.lit(100.0)))
    )


def cagr(future: Column, current: Column, years: Column) -> Column:
    """Percent growth a year to one decimal; null unless all three are positive."""
    ok = (future > 0) & (current > 0) & (years > 0)
    return F.when(ok, F.round((F.pow(future / current, F.lit(1.0) / years) - 1) * 100, 1))


def net_margin_equivalent(guided_hi: Column, metric: Column, trailing_net: Column, ebitda_margin: Column, pbt_margin: Column) -> Column:
    """A guided margin as a fraction of net margin at today's conversion, at least the trailing one.

    Without a margin of the same kind to compare with, the trailing one; a margin of zero counts as none.
    """
    basis = F.when(metric == "ebitda_margin_pct", ebitda_margin).when(metric == "pbt_margin_pct", pbt_margin)
    net, basis = F.nullif(trailing_net, F.lit(0)), F.nullif(basis, F.lit(0))
    return F.when(guided_hi.isNotNull(), F.coalesce(F.greatest(net * guided_hi / basis, F.when(basis.isNotNull(), net)), net) / 100)


def forward_growth(metric: Column, value: Column, unit: Column, timeframe: Column, currency: Column, call_fy2: int = 24) -> Column:
    """struct(status, low, high, reason): the growth a year that a target implies.

    Percentages are rates already, multiples are spread over the horizon, money needs a base.
    """
    m, u = F.lower(F.trim(F.coalesce(metric, F.lit("none")))), F.lower(F.trim(F.coalesce(unit, F.lit(""))))
    v, y = spread(value), years_ahead(timeframe, call_fy2)
    v_lo, v_hi, y_lo, y_hi = v["lo"], v["hi"], y["lo"], y["hi"]
    percent, times = u.isin("%", "percent", "pct"), u.isin("times", "x", "multiple", "fold")
    money = u.isin("crore", "cr", "lakh", "million", "mn", "billion", "bn")
    reason = (
        F.when(m.isin("none", ""), F.lit(None).cast("string"))
        .when(v_lo.isNull(), "value")
        .when(percent, F.lit(None).cast("string"))
        .when(times & y_lo.isNull(), "timeframe")
        .when(times & ((v_lo <= 0) | (y_lo <= 0) | (y_hi <= 0)), "non-positive")
        .when(times, F.lit(None).cast("string"))
        .when(money & (rough_crore(v_hi, u, currency) > ABSURD_CRORE), "absurd")
        .when(~money, "unit")
    )
    status = F.when(m.isin("none", ""), "none").when(reason.isNotNull(), "unparseable").when(percent | times, "ok").otherwise("needs_base")
    low = F.when(percent, v_lo / 100).when(times, F.pow(v_lo, F.lit(1.0) / y_hi) - 1)
    high = F.when(percent, v_hi / 100).when(times, F.pow(v_hi, F.lit(1.0) / y_lo) - 1)
    ok = status == "ok"
    return F.struct(status.alias("status"), F.when(ok, low).alias("low"), F.when(ok, high).alias("high"), reason.alias("reason"))


def rank_value(growth: Column) -> Column:
    """Lower growth of a target for ranking; minus infinity if it has none."""
    return F.when(growth["status"] == "ok", growth["low"]).otherwise(F.lit(float("-inf")))


def value_key(value: Column) -> Column:
    """A value for comparing: its parts to one decimal and in order ('20-18.04' -> '18.0-20.0'); other texts in lower case."""
    v = F.replace(F.replace(F.trim(value), F.lit(","), F.lit("")), F.lit("–"), F.lit("-"))
    numbers = F.transform(F.split(v, "-"), lambda p: F.round(F.trim(p).try_cast("decimal(38,10)"), 1).cast("decimal(38,1)"))
    ok = ~F.exists(numbers, lambda n: n.isNull())
    return F.when(ok, F.array_join(F.transform(F.array_sort(numbers), lambda n: n.cast("string")), "-")).otherwise(F.lower(v))


def clean_value(value: Column) -> Column:
    """A number or range without approximation words, ' to ' and a closing percent sign; null if none is left."""
    ok = rf"^{NUMBER}(?:-{NUMBER})?$"
    v = F.trim(value)
    w = F.trim(F.regexp_replace(v, APPROXIMATE, ""))
    w = F.trim(F.rtrim(F.regexp_replace(w, r"(?i)\s+to\s+", "-"), F.lit("%")))
    return F.when(v.rlike(ok), v).when(w.rlike(ok), w)


def within(truth: Column, found: Column, tolerance: float) -> Column:
    """Whether a found number is within a share of the true one; two nulls agree, a true zero only with zero."""
    both = truth.isNotNull() & found.isNotNull()
    return F.when(truth.isNull() & found.isNull(), True).when(~both, False).when(truth == 0, found == 0).otherwise(F.abs(truth - found) / truth <= tolerance)


def credible_metric(metric: Column) -> Column:
    """Whether a metric counts for credibility: one of the profit and loss metrics, by name alone."""
    return ~metric.startswith("other_") & metric.isin(*CREDIBLE)


def credible_item(metric: Column, level: Column, horizon: Column) -> Column:
    """The stricter rule: a profit and loss metric of the company, in the near term."""
    return credible_metric(metric) & (level == "company") & (horizon == "near")
