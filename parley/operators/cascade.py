"""From guidance items and fundamentals to implied profit growth, and the rankings made of it.

Items: company, ord, metric, value, unit, currency, timeline, level, horizon, page.
Every step is a projection, one window over (company, block, class) or one aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.binding import let
from . import fiscal, values

#: An absolute revenue target that implies more growth a year than this is a mislabelled figure.
MAX_GROWTH = 1.0
# Preferred and fallback metric of each class of drivers.
CLASSES = {"pat": ("pat_absolute", "pat_growth_pct"), "revenue": ("revenue_absolute", "revenue_growth_pct"), "margin": ("ebitda_margin_pct", "pbt_margin_pct")}


def driver_class(metric: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, metrics in CLASSES.items():
        out = F.when(metric.isin(*metrics), F.lit(name)).otherwise(out)
    return out


def block_of(horizon: Column) -> Column:
    """near, or long for medium and long."""
    return let(horizon, lambda h: F.when(h == "near", "near").when(h.isin("medium", "long"), "long"))


def ranked_drivers(items: DataFrame, by_page: bool = True, multiples: bool = False) -> DataFrame:
    """Items of the driver classes without repeats, with `class` and `rank` within (company, block, class).

    The preferred metric comes first, then whole years, larger values, and with
    by_page later pages; `ord` breaks ties and chooses among repeats of the same
    (metric, value, timeline).
    """
    rows = items.withColumn("class", driver_class(F.col("metric"))).where("class is not null and block is not null")
    bounds = values.bounds(F.col("value"), multiples)
    preferred = F.col("metric").isin(*(m[0] for m in CLASSES.values()))
    whole_year = F.coalesce(F.col("timeline") != "", F.lit(False)) & ~F.coalesce(F.col("timeline").rlike(r"(?i)\b(H[12]|Q[1-4])\b"), F.lit(False))
    rows = rows.withColumns({"lo": bounds["lo"], "hi": bounds["hi"], "__pref": preferred, "__whole": whole_year})
    repeat = Window.partitionBy("company", "block", "class", "metric", "value", "timeline").orderBy("ord")
    rows = rows.withColumn("__again", F.row_number().over(repeat)).where("__again = 1")
    order = [F.col("__pref").desc(), F.col("__whole").desc(), F.coalesce("hi", "lo", F.lit(-1.0)).desc(), *([F.coalesce("page", F.lit(0)).desc()] if by_page else []), F.col("ord")]
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("company", "block", "class").orderBy(*order))).drop("__pref", "__whole", "__again")


def _candidates(items: DataFrame, fundamentals: DataFrame, convert: bool, every_revenue: bool) -> DataFrame:
    """Growth that each usable driver implies, with its place in the order of preference."""
    by_page, multiples = not convert, convert
    drivers = ranked_drivers(items, by_page, multiples)
    margins = drivers.where("class = 'margin' and rank = 1").select(F.col("company").alias("__mc"), F.col("block").alias("__mb"), F.col("metric").alias("margin_metric"), F.col("hi").alias("margin_hi"))
    kept = drivers.where("class = 'pat' and rank = 1 or class = 'revenue'" + ("" if every_revenue else " and rank = 1"))
    rows = kept.join(margins, (F.col("company") == F.col("__mc")) & (F.col("block") == F.col("__mb")), "left").join(fundamentals, "company")
    rows = rows.where("current_pat is not null and current_revenue is not null and net_margin is not null")
    if convert:
        rows = rows.where("current_pat > 0 and current_revenue <> 0")
    span = fiscal.year_range(F.col("timeline"))
    rows = rows.withColumns({"fy_lo": span["lo"], "fy_hi": span["hi"]}).where("lo is not null and fy_lo is not null")
    call, line = F.col("call_fy"), F.col("timeline")
    rows = rows.withColumns({"yb": fiscal.years_until(F.col("fy_hi"), call, line), "yu": fiscal.years_until(F.col("fy_lo"), call, line)})
    lo, hi = F.col("lo"), F.coalesce(F.nullif("hi", F.lit(0.0)), F.col("lo"))
    rows = rows.withColumn("factor", values.crore_factor(F.col("unit"), F.col("currency"), F.col("usdinr")) if convert else F.lit(1.0))
    money = lambda v: v * F.col("factor")
    pat, revenue, yb, yu = F.col("current_pat"), F.col("current_revenue"), F.col("yb"), F.col("yu")
    grown = lambda base, pct, years: base * F.pow(1 + pct / 100, years)
    unit = F.lower(F.trim(F.coalesce("unit", F.lit(""))))
    times = unit.isin("times", "x", "multiple", "fold") if convert else unit == "times"
    trailing = F.col("net_margin") / 100
    guided = values.net_margin_equivalent(F.col("margin_hi"), F.col("margin_metric"), F.col("net_margin"), F.col("ebitda_margin"), F.col("pbt_margin"))
    bull_margin = F.greatest(F.coalesce(guided, trailing), trailing)
    absolute = F.col("metric") == "revenue_absolute"
    # step by step, so that no expression is repeated inside another
    rev_lo = F.when(absolute, money(lo)).when(times, revenue * lo).otherwise(grown(revenue, lo, yb))
    rev_hi = F.when(absolute, money(hi)).when(times, revenue * hi).otherwise(grown(revenue, hi, yu))
    rows = rows.withColumns({"rev_lo": rev_lo, "rev_hi": rev_hi, "bull_margin": bull_margin})
    target = lambda v, years, rev, margin: F.when(F.col("metric") == "pat_absolute", money(v)).when(F.col("metric") == "pat_growth_pct", grown(pat, v, years)).otherwise(rev * margin)
    rows = rows.withColumns({"future_lo": target(lo, yb, F.col("rev_lo"), trailing), "future_hi": target(hi, yu, F.col("rev_hi"), F.col("bull_margin"))})
    rows = rows.withColumns({"base": values.cagr(F.col("future_lo"), pat, yb), "bull": values.cagr(F.col("future_hi"), pat, yu)})
    if convert:
        rows = rows.where(~(absolute & (F.col("rev_lo").isNull() | (F.pow(F.col("rev_lo") / revenue, 1 / yb) - 1 > MAX_GROWTH))))
    label = values_label(rows)
    return rows.where("base is not null").withColumns({"basis": label, "place": F.when(F.col("class") == "pat", F.lit(0)).otherwise(F.col("rank"))})


def values_label(rows: DataFrame) -> Column:
    from .text import item_label

    return item_label(F.col("metric"), F.col("value"), F.col("unit"), F.col("currency"), F.col("timeline"))


def block_growth(items: DataFrame, fundamentals: DataFrame, convert: bool = True) -> DataFrame:
    """(company, block, base, bull, basis): growth of profit a year that a block of items implies.

    Profit targets come before revenue with margin. base takes the lower value and the
    last year, bull the upper value and the first year. convert: money is brought to
    rupee crores, every revenue candidate is tried in its order and implausible ones
    are passed over; otherwise only the first is tried, in the units as told.
    fundamentals: company, current_revenue, current_pat, net_margin, ebitda_margin,
    pbt_margin, call_fy and, to convert, usdinr. Companies without a base have no rows.
    """
    found = _candidates(items, fundamentals, convert, convert)
    best = F.min_by(F.struct("base", "bull", "basis"), F.struct("place", "ord"))
    return found.groupBy("company", "block").agg(best.alias("b")).select("company", "block", "b.base", "b.bull", "b.basis")


def call_year(file_name: Column, header: Column, default: int = 2026) -> Column:
    """struct(fy, source, mismatch): the fiscal year of a call from the name of its file, else from its header, else the default.

    mismatch: both name a year and they differ.
    """
    named, told = fiscal.period_year(file_name), fiscal.period_year(header)
    source = F.when(named.isNotNull(), "file").when(told.isNotNull(), "header").otherwise("default")
    return F.struct(F.coalesce(named, told, F.lit(default)).alias("fy"), source.alias("source"), F.coalesce(named != told, F.lit(False)).alias("mismatch"))


def by_block(growth: DataFrame) -> DataFrame:
    """One row for each company: near_base, near_bull, long_base, long_bull."""
    at = lambda block, c: F.max(F.when(F.col("block") == block, F.col(c))).alias(f"{block}_{c}")
    return growth.groupBy("company").agg(*(at(b, c) for b in ("near", "long") for c in ("base", "bull")))


def acceleration(items: DataFrame, fundamentals: DataFrame) -> DataFrame:
    """Ranking by forward less trailing growth: every company of `fundamentals`, best first, those without at the end.

    The forward growth is the larger of the two blocks, near before long at a tie;
    the difference needs a trailing status of ok.
    """
    blocks = by_block(block_growth(items, fundamentals, True))
    rows = fundamentals.join(blocks, "company", "left")
    near = F.col("near_base").isNotNull() & (F.col("long_base").isNull() | (F.col("near_base") >= F.col("long_base")))
    forward = F.when(near, F.col("near_base")).otherwise(F.col("long_base"))
    rows = rows.withColumns({"fwd_base": forward, "fwd_bull": F.when(near, F.col("near_bull")).otherwise(F.col("long_bull")), "fwd_horizon": F.when(near, "near").when(F.col("long_base").isNotNull(), "long").otherwise("—")})
    ok = (F.col("status") == "ok") & F.col("fwd_base").isNotNull()
    difference = lambda c: F.when(ok, F.round(F.col(c) - F.col("pat_cagr"), 1))
    return rows.withColumns({"accel_base": difference("fwd_base"), "accel_bull": difference("fwd_bull")}).orderBy(F.col("accel_base").desc_nulls_last(), "company")


def revenue_acceleration(items: DataFrame, fundamentals: DataFrame) -> DataFrame:
    """The same ranking of revenue: forward growth of revenue less its trailing growth (revenue_cagr of `fundamentals`)."""
    as_profit = {"current_pat": F.col("current_revenue"), "net_margin": F.lit(100.0), "pat_cagr": F.col("revenue_cagr"), "status": F.when(F.col("revenue_cagr").isNotNull(), "ok").otherwise("missing")}
    return acceleration(items.where(driver_class(F.col("metric")) == "revenue"), fundamentals.withColumns(as_profit))


def forward_valuation(items: DataFrame, fundamentals: DataFrame) -> DataFrame:
    """Ranking by forward price to earnings over growth, lowest first, companies without one at the end.

    `fundamentals` also has forward_pe. A growth of zero gives no ratio, a negative one a negative ratio.
    """
    blocks = by_block(block_growth(items, fundamentals, False))
    rows = fundamentals.join(blocks, "company", "left")
    best = F.nullif(F.greatest("near_base", "long_base"), F.lit(0.0))
    rows = rows.withColumns({"best_base": F.greatest("near_base", "long_base"), "forward_peg": F.round(F.nullif(F.col("forward_pe"), F.lit(0.0)) / best, 2)})
    return rows.orderBy(F.col("forward_peg").asc_nulls_last(), "company")


def other_signals(items: DataFrame) -> DataFrame:
    """(company, signals): the items of segments and geographies as short labels in their order."""
    from .text import signal_label

    label = signal_label(F.col("level"), F.col("metric"), F.col("value"), F.col("unit"), F.col("currency"), F.col("timeline"))
    rows = items.where("level <> 'company'").select("company", F.struct("ord", label.alias("s")).alias("x"))
    return rows.groupBy("company").agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["s"]), " | ").alias("signals"))
