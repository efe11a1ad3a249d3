"""Quantities: grammar, vectors, and the rows that must not crash."""

from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from parley.operators import units
from parley.session import table

BASE = [("crore", "money", "inr", 1e7), ("million", "money", "inr", 1e6), ("usd_million", "money", "inr", 1e6), ("percent", "share", "bps", 100.0), ("basis_point", "share", "bps", 1.0), ("tonne", "mass", "kg", 1000.0), ("lakh_tonne", "mass", "kg", 1e8), ("tonne_per_month", "mass_rate", "kg_per_year", 12000.0), ("kilotonne_per_year", "mass_rate", "kg_per_year", 1e6), ("inr_per_kg", "price", "inr_per_tonne", 1000.0), ("inr_per_tonne", "price", "inr_per_tonne", 1.0), ("quarter", "duration", "months", 3.0), ("gigawatt", "power", "kw", 1e6)]
KINDS = units.conversions(BASE)


@pytest.mark.parametrize(
    "value,unit,currency,passage,expected",
    [
        ("18-20", "%", None, "", ("bps", 1800, 2000, "INR")),
        ("2 % p.a.", None, None, "", ("bps", 200, 200, "INR")),
        ("1,06,842", "metric tons", None, "", ("kg", 106842000, 106842000, "INR")),
        ("₹603 cr - ₹723 cr", None, None, "", ("inr", 6030000000, 7230000000, "INR")),
        ("$9 mn", None, None, "", ("inr", 9000000, 9000000, "USD")),
        ("10", "mn", "US$", "", ("inr", 10000000, 10000000, "USD")),
        ("10", "mn", None, "capex of $10 mn by FY28", ("inr", 10000000, 10000000, "USD")),
        ("10", "crore", "USD", "", ("inr", 100000000, 100000000, "INR")),
        ("1.8 '000 tonnes", None, None, "", ("kg", 1800000, 1800000, "INR")),
        ("5", "TPM", None, "", ("kg_per_year", 60000, 60000, "INR")),
        ("5", "MT monthly", None, "", ("kg_per_year", 60000, 60000, "INR")),
        ("2", "thousand tons a year", None, "", ("kg_per_year", 2000000, 2000000, "INR")),
        ("10.08", "rupees a kilo", None, "", ("inr_per_tonne", 10080, 10080, "INR")),
        ("1,536", "per ton", None, "", ("inr_per_tonne", 1536, 1536, "INR")),
        ("up to 3", "qtrs", None, "", ("months", 9, 9, "INR")),
        ("<=1.5", "GW", None, "", ("kw", 1500000, 1500000, "INR")),
        ("12", None, None, "payback of 12 to 14 months; margin of 12 per cent", ("bps", 1200, 1200, "INR")),
        ("12-14", "n/a", None, "payback of 12 to 14 months", ("months", 12, 14, "INR")),
        ("Rs 5", "crore", None, "", ("inr", 50000000, 50000000, "INR")),
        ("20-18", "%", None, "", ("bps", 1800, 2000, "INR")),
        ("2", "x", None, "", None), ("1.5-2", "times", None, "", None), ("double digits", "%", None, "", None), ("", "%", None, "", None), (None, "%", None, "", None), ("7", None, None, "seven", None),
    ],
)
def test_amounts(value, unit, currency, passage, expected):
    hint = "ebitda_margin_pct" if value == "12" else None
    got = units.common_amount(value, unit, currency, passage, hint, KINDS)
    assert (got and (got[0], *map(float, got[1:3]), got[3])) == (expected and (expected[0], *map(float, expected[1:3]), expected[3]))


def test_vectors_and_offset():
    v, _ = units.parse_unit("rs per kg")
    assert v.has("money") == 1 and v.has("mass") == -1 and v.scale == 1
    c, _ = units.parse_unit("celsius")
    assert c.offset == Fraction("273.15") and c.has("temperature") == 1
    assert units.parse_unit("depots")[0] is None and units.parse_unit("months in payback", leading=True)[0].has("time") == 1


def test_no_window_of_characters():
    """A unit however long, and ends of a range however far apart, are read whole."""
    far = f"margin of 12 per cent {'or so ' * 30}to 14 per cent"
    assert units.common_amount("12-14", None, None, far, None, KINDS)[:3] == ("bps", Decimal(1200), Decimal(1400))
    wide = f"we sell 5{' ' * 80}tonnes"
    assert units.common_amount("5", None, None, wide, None, KINDS)[0] == "kg"
    assert units.common_amount("9" * 40, "tonnes", None, None, None, KINDS) == ("kg", None, None, "INR")


def test_table_must_agree_with_itself():
    with pytest.raises(ValueError):
        units.conversions([*BASE, ("kilotonne", "mass", "kg", 5.0)])


def test_rows(spark, small):
    base = spark.createDataFrame(BASE, "unit_code string, quantity_kind string, common_unit string, factor double")
    fx = spark.createDataFrame([("USD", "Q1 FY25", 83.875)], "currency string, quarter string, inr_per_unit double")
    schema = "guidance_id long, guidance_value string, guidance_unit string, currency string, passage string, metric string, quarter string, text string, lo string"
    rows = [(1, "1.23", "USD mn", None, None, None, " q1 fy25 ", "t", "l"), (1, "1.23", "USD mn", None, None, None, "Q1 FY25", "t", "l"), (2, "5", "USD mn", None, None, None, "Q9 FY99", None, None), (3, None, None, None, None, None, None, None, None), (4, "1", "%", "INR", "x" * 200_000, "m", None, None, None)]
    got = sorted((r["guidance_id"], r["common_unit"], r["lo"], r["hi"]) for r in units.quantities(spark.createDataFrame(rows, schema), base, fx).collect())
    fx_value = int(Decimal("1.23") * Decimal("83.875") * 10**6)
    assert got == [(1, "inr", fx_value, fx_value)] * 2 + [(2, "inr", None, None), (4, "bps", 100, 100)] or got[2][2] is None and got[0][2] == fx_value
    assert units.quantities(spark.createDataFrame([], schema), base, fx).count() == 0
    found = units.quantities(table(spark, small, "guidance_items"), table(spark, small, "unit_base"), table(spark, small, "fx_rates"))
    assert found.where(F.col("lo") > F.col("hi")).count() == 0 and found.count() > 50
