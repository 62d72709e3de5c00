from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lotwise.functions import classify as C
from lotwise.functions import text as T
from lotwise.plans.discounts import discount_columns


def one(spark, values, schema, *columns):
    df = spark.createDataFrame(values, schema).select(*columns)
    return [tuple(r) if len(columns) > 1 else r[0] for r in df.collect()]


def test_age(spark):
    days = [None, 0, 15, 16, 30, 31, 45, 46, 60, 61, 90, 91, 120, 121]
    got = one(spark, [(d,) for d in days], "d int", C.age_bucket(F.col("d")))
    assert got == [
        "N/A", "01: 0-15", "01: 0-15", "02: 16-30", "02: 16-30", "03: 31-45", "03: 31-45", "04: 46-60", "04: 46-60",
        "05: 61-90", "05: 61-90", "06: 91-120", "06: 91-120", "07: Over 120",
    ]
    collapsed = one(spark, [(g,) for g in ["N/A", "07: Over 120", "06: 91-120", "05: 61-90"]], "b string", C.collapse_age(F.col("b")))
    assert collapsed == ["01: 0-15", "06: >90", "06: >90", "05: 61-90"]
    limits = one(spark, [(d,) for d in [None, 44, 45]], "d int", C.threshold_bucket(F.col("d"), 45))
    assert limits == ["N/A", "Under 45 Days", "Over/At 45 Days"]
    bands = one(spark, [(d,) for d in [-1, 0, 45, 46, 120, 121, 1200, 1201, None]], "d int", C.age_band(F.col("d")))
    assert bands == ["Adjustments", "0-45", "0-45", "46-120", "46-120", "120+", "120+", "Adjustments", "Adjustments"]


def test_price_buckets_differ(spark):
    prices = [None, 0, 0.005, 0.01, 1, 20000, 20000.5, 20001, 40000, 40001, 1000000, 1000001]
    df = [(p if p is None else float(p), 500.0) for p in prices]
    inclusive = one(spark, df, "p double, c double", C.price_bucket_inclusive(F.col("p"), F.col("c")))
    low, mid, high = "1:0-20,000", "2:20,001 - 40,000", "3:Over 40,001"
    assert inclusive == [low, low, low, low, low, low, mid, mid, mid, high, high, low]
    opened = one(spark, df, "p double, c double", C.price_bucket_open(F.col("p")))
    assert opened == ["N/A", low, low, low, low, low, low, mid, mid, high, high, high]
    positive = one(spark, df, "p double, c double", C.price_bucket_positive(F.col("p")))
    assert positive[:5] == ["N/A", "N/A", "N/A", "N/A", low]
    band = one(spark, [(None, 25000.0), (0.5, None), (20000.0, 1.0)], "a double, b double", C.price_band(F.col("a"), F.col("b")))
    assert band == ["$20-$40k", "Adjustments", "$0-$20k"]


def test_valid_price(spark):
    got = one(spark, [(1, 1, 1), (0, 1, 1), (1, None, 1), (2, 2, 0)], "p int, c int, t int", C.valid_price(F.col("p"), F.col("c"), F.col("t")))
    assert got == ["Valid", "N/A", "N/A", "N/A"]


def test_gate(spark):
    cases = [
        (1, 15000, 14000), (0, 15000, 14000), (1, None, 14000), (1, 0, 14000), (1, 15000, None), (1, 15000, 0),
        (1, 24000, 14000), (1, 24001, 14000), (1, 14000, 24000), (1, 14000, 24001), (1, 999, 5000), (1, 5000, 999), (None, 15000, 14000),
    ]
    ok = C.price_gate(F.col("n"), F.col("p"), F.col("t"))
    got = one(spark, cases, "n int, p int, t int", C.gated(ok, F.col("p")))
    assert got == [15000, 0, 0, 0, 0, 0, 24000, 0, 14000, 0, 0, 0, 15000]


def test_price_rank(spark):
    prices = [99.0, 100.0, 100.01, 110.0, 110.01, 120.01, 130.0, 130.01, None]
    rank = C.price_rank(F.col("p"), F.lit(100.0), F.lit(110.0), F.lit(120.0), F.lit(130.0))
    got = one(spark, [(p,) for p in prices], "p double", rank)
    assert got == ["CG_Great", "CG_Great", "CG_Good", "CG_Good", "CG_Fair", "CG_High", "CG_High", "CG_Overpriced", "CG_Unk"]


def test_sources(spark):
    cases = [("Rental-Co", "WEBUYYOURCAR", None), (None, "trade-in", "Other"), ("x", "y", "LEASE RETURN"), ("x", None, None)]
    got = one(spark, cases, "o string, c string, h string", C.source_group(F.col("o"), F.col("c"), F.col("h")))
    assert got == ["AUCTION/RENTAL", "TRADE-IN", "LEASE RETURN", "Other"]
    sale = one(spark, [("From desk X", "Trade-in"), ("a", "Trade-In"), (None, "Manufacturer"), ("a", None)], "n string, t string",
               C.sale_source(F.col("n"), F.col("t")))
    assert sale == ["Auction", "Trade", "ExLoaner", "Other"]
    acq = one(spark, [("rental company",), ("Loaner",), (None,)], "s string", C.acquisition_group(F.col("s")))
    assert acq == ["Auction/Rental", "Service Loaner", "NONE"]


@pytest.mark.parametrize(
    ("variant", "expected"),
    [
        ("rollup", ["CDJR", "Ford", "FIAT", "Kia", None, "Hyundai"]),
        ("plan", ["CDJR", "FORD", "CDJR", "Kia", None, "HYUNDAI"]),
        ("spine", ["CDJR", "Ford", "Others", "Others", "Others", "Hyundai"]),
        ("tracker", ["Chrysler", "Ford", "Chrysler", "Kia", None, "Hyundai"]),
        ("availability", ["CDJR", "Ford LM", "CDJR", "Kia", None, "Hyundai"]),
    ],
)
def test_brand_variants(spark, variant, expected):
    makes = ["Jeep", "LINCOLN", "FIAT", "Kia", None, "Genesis"]
    assert one(spark, [(m,) for m in makes], "m string", C.brand_group(F.col("m"), variant)) == expected


def test_segments(spark):
    makes = [("Fiat",), ("PORSCHE",), (None,)]
    assert one(spark, makes, "m string", C.segment(F.col("m"), "plan")) == ["Domestic", None, None]
    assert one(spark, makes, "m string", C.segment(F.col("m"), "plan_weekly")) == [None, None, None]
    assert one(spark, makes, "m string", C.segment(F.col("m"), "spine")) == ["Others", "Premium Luxury", "Others"]
    brands = [("Mini",), ("MINI",), ("Chrysler",), (None,)]
    assert one(spark, brands, "b string", C.brand_segment(F.col("b"))) == ["Luxury", "Other", "Domestic", "Other"]
    assert one(spark, [("MINI",), ("ZZ",), (None,)], "c string", C.industry_brand(F.col("c"))) == ["MINI", "Unknown", "Unknown"]


def test_distance(spark):
    miles = ["-1", "0", "4.99", "5.00", "9.99", "74.99", "74.995", "75", "99.99", "99.995", "150"]
    got = one(spark, [(Decimal(m),) for m in miles], "m decimal(9,3)", C.distance_band(F.col("m")))
    assert [g.split(":")[0] for g in got] == ["12", "1", "1", "2", "2", "8", "12", "9", "9", "12", "11"]
    dist = one(spark, [(1.0, 1.0, 1.0, 1.1), (None, 1.0, 1.0, 1.0)], "a double, b double, c double, d double",
               C.distance_miles(F.col("a"), F.col("b"), F.col("c"), F.col("d")))
    assert dist == [Decimal("5.30"), Decimal("-1.00")]


def test_leads(spark):
    cases = [("RANGE TRADE (VOI)", "x", "y"), ("SELL ONLY", "x", "y"), ("SELL ONLY", "WBYC-SHOWROOM", "y"),
             ("OTHER", "Cargurus", "Sell my car"), ("UNKNOWN", "x", None), (None, "x", "y")]
    got = one(spark, cases, "g string, p string, s string", C.lead_group(F.col("g"), F.col("p"), F.col("s")))
    assert got == ["NON-WBYC LEAD", "OWN SITE SELL ONLY LEAD", "SELL ONLY", "CARGURUS-Sell My Car", "NON-WBYC LEAD", None]


def test_flags(spark):
    assert one(spark, [("electric fuel system",), ("x",), (None,)], "f string", C.ev_flag(F.col("f"))) == ["EV", "ICE", "ICE"]
    strict = one(spark, [("EV", "Gas/Electric Hybrid"), ("EV", "Gas"), (None, "Electric Fuel System")], "e string, f string",
                 C.ev_flag_strict(F.col("e"), F.col("f")))
    assert strict == ["EV", "Non-EV", "Non-EV"]
    stores = [(None,), ("",), ("S1",)]
    assert one(spark, stores, "s string", C.store_or_competition(F.col("s"), True)) == ["Competition", "Competition", "S1"]
    assert one(spark, stores, "s string", C.store_or_competition(F.col("s"), False)) == ["Competition", "", "S1"]
    assert one(spark, [("Group Cars A",), ("Other",)], "s string", C.franchise_type(F.col("s"), "Group Cars")) == ["Non-Franchise", "Franchise"]


def test_discount_columns(spark):
    rows = [(90.0, 95.0, 100.0, "Ford", 50), (90.0, 0.0, 100.0, "Ford", 50), (90.0, None, 100.0, "Ford", 10), (90.0, 95.0, 100.0, "BMW", 10),
            (None, None, 100.0, "Ford", 46), (110.0, 120.0, 100.0, "Ford", 45)]
    cols = discount_columns(F.col("w"), F.col("e"), F.col("m"), F.col("make"), F.col("d"))
    got = one(spark, rows, "w double, e double, m double, make string, d int",
              *[cols[c].alias(c) for c in ("discounted", "avg_discount", "discount_opportunity")])
    assert got == [("Yes", 7.5, "N/A"), ("No", 0.0, "Opportunity"), ("Yes", 10.0, "N/A"), ("Yes", 5.0, "N/A"), ("No", 0.0, "Opportunity"),
                   ("No", 0.0, "N/A")]


def test_text(spark):
    assert one(spark, [("LAND ROVER",), ("x",), ("",), (None,)], "s string", T.first_cap(F.col("s"))) == ["Land rover", "X", "", None]
    assert one(spark, [("2071.0",), ("2071",), ("ab",), ("1e3",)], "s string", T.id_cleanup(F.col("s"))) == ["2071", "2071", "ab", "1000"]
    assert one(spark, [("a&amp;lt; b<br/>c<i>d</i>",)], "s string", T.clean_html(F.col("s"), ", ")) == ["a&lt; b, cd"]
    parts = one(spark, [("1 Main St, Suite 2, , Town, ST 123",), ("Town, ST",), ("",)], "s string", T.split_address(F.col("s")))
    assert [tuple(p) for p in parts] == [
        ("1 Main St, Suite 2", "Town", "ST 123", "1 Main St, Suite 2, Town, ST 123"), (None, None, None, "Town, ST"), (None, None, None, ""),
    ]
    assert one(spark, [(" a ", None, 3)], "x string, y string, z int", T.composite_key(F.col("x"), F.col("y"), F.col("z"))) == ["a3"]
    df = T.normalize_headers(spark.createDataFrame([(1, 2)], [" a b", "C"]))
    assert df.columns == ["A B", "C"]


def test_references_resolve_before_tags_go(spark):
    cells = ["&lt;b&gt;x&lt;/b&gt;", "caf&eacute; &#8217;&#x1F600;&rsquo;", "&unknown; &#0; a & b;", "&amp;eacute;", "a&nbsp;b", None]
    want = ["x", "café \u2019\U0001f600\u2019", "&unknown; &#0; a & b;", "&eacute;", "a b", None]
    assert one(spark, [(c,) for c in cells], "s string", T.clean_html(F.col("s"), ", ")) == want


def test_long_ids_keep_their_digits(spark):
    cells = ["12345678901234567", "12345678901234567.0", "99999999999999999999", "12.5", "x1"]
    assert one(spark, [(c,) for c in cells], "s string", T.id_cleanup(F.col("s"))) == [
        "12345678901234567", "12345678901234567", "99999999999999999999", "12", "x1",
    ]
