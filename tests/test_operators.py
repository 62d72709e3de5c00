import random
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lotwise.operators import history as H
from lotwise.operators import lookup as LK
from lotwise.operators import matching as MT
from lotwise.operators import measures as MS
from lotwise.operators import predicates as P
from lotwise.operators import rules as RU
from lotwise.operators import stacking as ST
from lotwise.operators import windows as W
from lotwise.operators.rules import Rule, apply_if_found, apply_if_missing, first_match
from lotwise.plans import allocation_groups as AG
from lotwise.plans import market_share as MK
from lotwise.plans.new_sales import assign_periods
from lotwise.plans.upkeep import upsert_plan_history


def test_lookup_last_wins_and_row_count(spark, rows):
    facts = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, v int")
    dim = spark.createDataFrame([("a", "old", 1), ("a", "new", 2), (None, "x", 3)], "k string, label string, pos int")
    last = LK.dedupe_last(dim, ["k"], ["pos"])
    joined = LK.lookup(facts, last, ["k"], ["label"], "none")
    assert rows(joined, "k", "v", "label") == [("a", 1, "new"), ("a", 2, "new"), ("b", 3, "none"), (None, 4, "none")]
    assert LK.lookup(facts, dim, ["k"], ["label"]).count() == 6  # a repeated key fans out


def test_override_blank(spark, rows):
    df = spark.createDataFrame([("1", ""), ("2", ""), ("1", "own"), ("1", None)], "site string, store string")
    dim = spark.createDataFrame([("1", "over")], "site string, o string")
    assert rows(LK.override_blank(df, dim, ["site"], {"store": "o"})) == [("1", "over"), ("1", "own"), ("1", None), ("2", None)]


def test_backfill(spark, rows):
    df = spark.createDataFrame([("m1", "nomap"), ("m2", "keep"), ("m3", "NOMAP")], "id string, g string")
    hist = spark.createDataFrame([("m1", "old", 2020), ("m1", "new", 2021), ("m2", "other", 2022)], "id string, g string, year int")
    got = LK.backfill_from_history(df, hist, "id", "g", ["year"], "nomap")
    assert rows(got, "id", "g", "was_missing") == [("m1", "new", True), ("m2", "keep", False), ("m3", "nomap", True)]


def test_densify(spark):
    dates = spark.createDataFrame([(date(2025, 1, 1),), (date(2025, 1, 1),), (date(2025, 2, 1),)], "d date")
    assert LK.densify(dates, "d", "brand", ["A", "B", "C"]).count() == 6


def test_max_per_keeps_null_group(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 3), (None, 2)], "k string, v int")
    assert rows(LK.max_per(df, ["k"], "v", "top")) == [("a", 1, 3), ("a", 3, 3), (None, 2, 2)]


def test_share_sums_to_one_and_null_keys(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 3), (None, 5), (None, 5)], "k string, v int")
    got = MS.share_of_total(df, ["k"], "v", "total", "share")
    assert rows(got, "k", "v", "total", "share") == [("a", 1, 4, 0.25), ("a", 3, 4, 0.75), (None, 5, 10, 0.5), (None, 5, 10, 0.5)]


def test_half_even(spark):
    df = spark.createDataFrame([(1, 16), (3, 16)], "a int, b int")
    got = df.select(MS.round_half_even(MS.per_unit(F.col("a"), F.col("b")), 3)).collect()
    assert [r[0] for r in got] == [0.062, 0.188]


def test_ytd_carries_gap_months(spark, rows):
    df = spark.createDataFrame([("s", 2025, 1, 5), ("s", 2025, 3, 2), ("t", 2025, 4, 9), ("s", 2024, 2, 1)], "k string, y int, m int, v int")
    got = MS.ytd_by_month(df, ["k", "y"], "m", "v", date(2025, 3, 20), "ytd", "time")
    assert rows(got, "k", "y", "time", "ytd") == sorted([
        ("s", 2025, "YTDJan", 5), ("s", 2025, "YTDFeb", 5), ("s", 2025, "YTDMar", 7), ("s", 2024, "YTDFeb", 1), ("s", 2024, "YTDMar", 1),
    ], key=str)


def test_aggregate_helpers(spark):
    df = spark.createDataFrame([(1, 50, None), (2, -60, 4), (1, 3, 1)], "n int, d int, c int")
    got = df.agg(
        MS.sum_if_max(F.col("d"), 45, F.col("n")).alias("a"), MS.sum_if_max(F.col("d"), 60, F.col("n")).alias("b"),
        MS.recon_cost(F.col("n"), F.col("c"), F.col("d")).alias("r"),
    ).first()
    assert tuple(got) == (4, 0, 54)
    row = df.select(MS.row_mean(F.col("n"), F.col("c")), MS.cap(F.col("n"), F.col("c")), MS.row_nonnull(F.col("n"), F.col("c"))).collect()
    assert [tuple(r) for r in row] == [(1.0, 1, 1), (3.0, 2, 2), (1.0, 1, 2)]
    assert df.filter(MS.total_nonzero(F.col("n"), F.col("c"))).count() == 2  # NULL part drops the row
    assert df.filter(MS.any_nonzero(F.col("n"), F.col("c"))).count() == 3


def test_group_sum_null_keys(spark, rows):
    df = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    assert rows(MS.group_sum(df, ["k"], ["v"], drop_null_keys=True)) == [("a", 1)]
    assert rows(MS.group_sum(df, ["k"], ["v"])) == [("a", 1), (None, 2)]


def test_latest_earliest_prefer(spark, rows):
    df = spark.createDataFrame([("v", 1, "x"), ("v", 3, "y"), ("v", None, "z"), (None, 1, "p"), (None, 2, "q")], "k string, o int, t string")
    assert rows(W.latest_per(df.filter("k is not null"), ["k"], ["o", "t"])) == [("v", 3, "y")]
    assert rows(W.earliest_per(df.filter("k is not null"), ["k"], ["o", "t"])) == [("v", None, "z")]
    assert rows(W.prefer_source(df, "k", ["o", "t"])) == [("v", None, "z"), (None, 1, "p"), (None, 2, "q")]


PRICES = [("u", "s", d, p, i) for i, (d, p) in enumerate([(1, 10), (2, 10), (3, 9), (4, 9), (5, 10), (5, 10)])]


def daily(spark):
    rows = [(u, s, date(2025, 1, d), p, i) for u, s, d, p, i in PRICES] + [("w", "s", date(2025, 1, 1), 5, 9), ("w", "s", date(2025, 1, 2), 5, 10)]
    return spark.createDataFrame(rows, "u string, s string, day date, price int, id int")


def test_price_runs_and_changes(spark, rows):
    runs = W.price_runs(daily(spark), "u", "s", "price", "day", ["id"])
    assert rows(runs.filter("u = 'u'"), "id", "appearance", "days_at_price", "from_last", "price_change_flag") == [
        (0, 1, 1, 4, 1), (1, 2, 2, 3, 0), (2, 3, 1, 2, 1), (3, 4, 2, 1, 0), (4, 5, 3, 2, 0), (5, 6, 4, 1, 0),
    ]
    changes = W.price_changes(runs, "u", "s")
    assert rows(changes, "u", "id", "max_changes") == [("u", 2, 3), ("u", 3, 3), ("u", 5, 3)]


def test_price_deltas_across_chunks(spark, rows):
    got = W.price_deltas(daily(spark), "u", "price", "day", ["id"])
    assert rows(got.filter("u = 'u'"), "id", "previous_price", "price_changed", "discount") == [
        (0, None, True, None), (1, 10, False, 0), (2, 10, True, 1), (3, 9, False, 0), (4, 9, True, -1), (5, 10, False, 0),
    ]


def test_numbering_keeps_rows_without_a_key(spark, rows):
    df = spark.createDataFrame(
        [(None, "s", 1, 10), (None, "s", 2, 20), (None, "s", 2, 30), ("u", None, None, 40), ("u", None, 1, 50)],
        "u string, s string, day int, id int",
    )
    got = W.chunked_row_number(df, ["u", "s"], "day", ["id"], "n", total="size")
    assert rows(got, "id", "n", "size") == [(10, 1, 3), (20, 2, 3), (30, 3, 3), (40, 1, 2), (50, 2, 2)]
    lag = W.chunked_lag(df, ["u", "s"], "day", ["id"], "id", "prev")
    assert rows(lag, "id", "prev") == [(10, None), (20, 10), (30, 20), (40, None), (50, 40)]


def test_carry_last_valid(spark, rows):
    df = spark.createDataFrame(
        [("u", 9, True, 0), ("u", 7, True, None), ("u", 5, True, 3), ("u", 4, True, 2), ("u", 2, True, 0), ("u", 1, True, 1)],
        "u string, days int, ch boolean, disc int",
    )
    got = W.carry_last_valid(df, "u", "days", F.col("ch"), F.col("disc"), [], "out")
    assert rows(got, "days", "out") == [(1, 2), (2, 2), (4, 4), (5, 7), (7, 7), (9, 9)]


def test_carry_along_a_hot_unit(spark):
    """Against a plain walk, with a third of the rows on one unit and ties on the day count."""
    rng = random.Random(4)
    data = [(i, "hot" if i % 3 == 0 else f"u{rng.randint(0, 20)}" if i % 50 else None, rng.randint(1, 15), rng.random() < 0.7, rng.choice([None, 0, 0, 2])) for i in range(900)]
    df = spark.createDataFrame(data, "id int, u string, days int, ch boolean, disc int").repartition(5)
    got = {r["id"]: r["out"] for r in W.carry_last_valid(df, "u", "days", F.col("ch"), F.col("disc"), ["id"], "out").collect()}
    want, seen = {}, {}
    for i, unit, days, changed, discount in sorted(data, key=lambda r: (-r[2], r[0])):
        want[i] = days
        if changed and discount:
            want[i] = seen.get(unit) or days
            seen[unit] = None
        elif changed:
            seen[unit] = days
    assert got == want


def test_flag_latest(spark, rows):
    df = spark.createDataFrame([(date(2025, 1, 1),), (date(2025, 1, 2),), (None,)], "d date")
    assert [r[1] for r in rows(W.flag_latest(df, "d", "f"))] == [0, 1, 0]


def test_history(spark, rows):
    old = spark.createDataFrame([(date(2025, 5, 1), 1), (date(2025, 5, 8), 2), (date(2025, 6, 1), 3)], "date date, v int")
    new = spark.createDataFrame([(9,)], "v int")
    got = H.roll_history(old, new, "date", date(2025, 6, 15))
    assert rows(got, "date", "v") == [(date(2025, 5, 8), 2), (date(2025, 6, 15), 3), (date(2025, 6, 15), 9)]
    hist = spark.createDataFrame([(2025, 5, 1), (2025, 6, 2), (None, 6, 3)], "year int, mth int, v int")
    fresh = spark.createDataFrame([(2025, 6, 20)], "year int, mth int, v int")
    once = H.replace_period(hist, fresh, ["year", "mth"])
    assert rows(once) == rows(H.replace_period(once, fresh, ["year", "mth"])) == [(2025, 5, 1), (2025, 6, 20), (None, 6, 3)]
    named = H.replace_named_period(hist, fresh, {"year": 2025, "mth": 6})
    assert rows(named) == rows(once)


def test_plan_history_upsert(spark, rows):
    hist = spark.createDataFrame([("202504", 1), ("202505", 2)], "year_month string, v int")
    new = spark.createDataFrame([("202505", 5), ("202506", 6)], "year_month string, v int")
    assert rows(upsert_plan_history(hist, new, date(2025, 5, 1))) == [("202504", 1), ("202505", 5)]


def test_drop_overlap(spark):
    df = spark.createDataFrame([(2024, 12), (2024, 11), (2024, 10), (2025, 12)], "sale_year int, sale_month int")
    assert P.drop_overlap(df, date(2025, 1, 20)).count() == 2


def test_not_in_and_exclude_treat_null_differently(spark):
    df = spark.createDataFrame([("A",), ("b",), (None,)], "m string")
    assert df.filter(P.ci_not_in(F.col("m"), ["a"])).count() == 1
    assert P.exclude_values(df, {"m": ["A"]}).count() == 2


def test_stacking(spark, rows):
    a = spark.createDataFrame([("x", 1)], "k string, n int")
    b = spark.createDataFrame([("y", None)], "k string, z string")
    assert rows(ST.stack_facts([a, b], {"n": 0}), "k", "n", "z") == [("x", 1, None), ("y", 0, None)]
    assert ST.combine_frames([a, b]).columns == ["k", "n"]
    with pytest.raises(ValueError):
        ST.combine_frames([])
    with pytest.raises(ValueError):
        ST.combine_frames([b.select("z")])
    assert ST.union_distinct(a, a).count() == 1


def test_periods_can_overlap(spark, rows):
    df = spark.createDataFrame([(date(2025, 1, 5),), (date(2025, 2, 1),), (date(2025, 3, 1),)], "d date")
    periods = [("A", date(2025, 1, 1), date(2025, 1, 31)), ("B", date(2025, 1, 5), date(2025, 2, 1))]
    assert rows(assign_periods(df, "d", periods), "d", "period") == [
        (date(2025, 1, 5), "A"), (date(2025, 1, 5), "B"), (date(2025, 2, 1), "B"),
    ]


def test_split_credit_preserves_totals(spark, rows):
    df = spark.createDataFrame([("a", None, Decimal(3)), ("a", "b", Decimal(2)), ("c", "c", Decimal(1))], "a1 string, a2 string, n decimal(10,0)")
    got = MT.split_credit(df, "a1", "a2", "n", "who")
    totals = {r.who: float(r.n) for r in got.groupBy("who").agg(F.sum("n").alias("n")).collect()}
    assert totals == {"a": 4.0, "b": 1.0, "c": 1.0}


FORM = [
    (1, "0001 East", "Ann", "O'Neil", "ann@x.com", "(555) 000-0001"),
    (2, "0001 East", "Ann", "ONeil", "other@x.com", "555.000.0001"),
    (3, "0001 East", "Bob", "Ray", "ann@x.com", None),
    (4, "0002 West", "Ann", "ONeil", "ann@x.com", "5550000001"),
    (5, "0001 East", "", "", "", ""),
    (6, "0001 East", "an", "nei", "ANN@X.COM", ""),
]
CUSTOMERS = [
    ("c1", "0001", "Anna", "ONeill", "Ann@x.com", "5550000001"),
    ("c2", "0001", "Bob", "Rayburn", "none@x.com", "5550000002"),
    ("c3", "0001", "Zed", "Zed", "", ""),
]


def brute_force():
    import re

    answers = set()
    for fid, market, first, last, email, phone in FORM:
        digits = re.sub(r"\D", "", phone or "")
        last = last.replace("'", "")
        for cust, cm, cf, cl, ce, cp in CUSTOMERS:
            if cm != market[:4]:
                continue
            flags = (
                bool(email) and ce.upper() == email.upper(), bool(digits) and cp == digits,
                bool(first) and bool(last) and first.upper() in cf.upper() and last.upper() in cl.upper(),
            )
            if sum(flags) >= 2:
                answers.add((fid, cust, *flags))
    return answers


@pytest.mark.parametrize("pairs_per_row", [0, 10_000])
def test_people_match_like_brute_force(spark, pairs_per_row):
    form = spark.createDataFrame(FORM, "form_id int, market_id string, first_name string, last_name string, email string, phone string")
    known = spark.createDataFrame(CUSTOMERS, "cust_no string, market_id string, first_name string, last_name string, email string, phone string")
    got = {
        (r.form_id, r.cust_no, r.email_match is not None, r.phone_match is not None, r.name_match is not None)
        for r in MT.match_people(form, known, pairs_per_row=pairs_per_row).collect()
    }
    assert got == brute_force() and {g[0] for g in got} == {1, 2, 6}


def _crowd(spark, customers: int, referrals: int):
    """One placeholder phone for all; e-mails and names are nearly all different."""
    known = spark.range(customers).selectExpr(
        "concat('c', id) AS cust_no", "'0001' AS market_id", "concat('Ann', id) AS first_name", "concat('Lee', id % 211, 'x') AS last_name",
        "concat('c', id, '@x.example') AS email", "'5550000' AS phone",
    )
    form = spark.range(referrals).selectExpr(
        "id AS form_id", "'0001 East' AS market_id", f"concat('ann', id % {customers}) AS first_name", f"concat('lee', id % {customers} % 211, 'X') AS last_name",
        "IF(id % 4 = 0, concat('C', id, '@x.example'), NULL) AS email", "'555-0000' AS phone",
    )
    return form, known


@pytest.mark.parametrize("sizes", [(40, 900), (900, 40), (300, 300)])
def test_people_match_on_a_value_hot_on_either_side(spark, sizes):
    form, known = _crowd(spark, *sizes)
    got, plain = (sorted(map(tuple, MT.match_people(form, known, pairs_per_row=n).collect()), key=str) for n in (0, 10**9))
    assert got == plain and len(got) >= sizes[1]


def test_people_match_emits_answers_from_a_hot_value(spark):
    """10,000 customers and a million referrals on one number: ten thousand million pairs on the number alone."""
    form, known = _crowd(spark, 10_000, 1_000_000)
    probes = form.selectExpr("'phone' AS kind", "phone AS value").unionAll(form.selectExpr("'none'", "string(form_id)"))
    others = known.selectExpr("'phone' AS kind", "'555-0000' AS value")
    assert [tuple(r) for r in MT.hot_values(probes, others, ["kind", "value"], 32).collect()] == [("phone", "555-0000")]
    assert MT.hot_values(probes, others.limit(30), ["kind", "value"], 32).isEmpty()  # a million rows, 30 pairs each
    matched = MT.match_people(form, known)
    answers = matched.count()
    # "ann7" occurs in Ann7, Ann70 and Ann700 if the last name fits too
    firsts = {}
    for c in range(10_000):
        firsts.setdefault(f"LEE{c % 211}X", []).append(f"ANN{c}")
    agree = sum(sum(f"ANN{i}" in name for name in firsts[f"LEE{i % 211}X"]) for i in range(10_000)) * 100
    assert answers == agree
    assert MT.candidate_pairs(form, known, "form_id", MT.PAIRS_PER_ROW).count() <= 2 * answers


def test_distinct_counts_merge_over_any_span(spark):
    """Overlapping months: the merged states against exact counts, a NULL key and NULL values among them."""
    df = spark.range(120_000).selectExpr(
        "IF(id % 40 = 0, NULL, id % 12) AS month", "IF(id % 11 = 0, NULL, hash(id) % 30000) AS vin", "IF(id % 3 = 0, 'hot', 's' || id % 5) AS store"
    )
    states = MS.distinct_states(df, ["month", "store"], "vin").cache()
    monthly = {(r[0], r[1]): r[2] for r in df.groupBy("month", "store").agg(F.countDistinct("vin")).collect()}
    assert {(r["month"], r["store"]): r["exact"] for r in states.collect()} == monthly
    for span in ("month BETWEEN 2 AND 7", "month = 1", "true", "month IS NULL"):
        exact = {r[0]: r[1] for r in df.filter(span).groupBy("store").agg(F.countDistinct("vin")).collect()}
        merged = {r["store"]: r["n"] for r in MS.merge_distinct(states.filter(span), ["store"], "n").collect()}
        assert merged.keys() == exact.keys() and all(abs(merged[s] - n) <= max(1, 4 * 0.01625 * n) for s, n in exact.items())
    assert states.selectExpr("max(length(state))").first()[0] <= 2**12 + 100
    assert MS.merge_distinct(states.limit(0), ["store"], "n").count() == 0


def test_exclude_seen_keeps_missing_keys(spark):
    df = spark.createDataFrame([("1",), ("2",), (None,)], "t string")
    prev = spark.createDataFrame([("1",), (None,)], "t string")
    assert MT.exclude_seen(df, prev, "t").count() == 2


def test_rules(spark):
    rules = [Rule("first", has={"m": ("AB",)}), Rule("second", is_any={"k": ("X",)}, lacks={"m": ("Z",)})]
    df = spark.createDataFrame([("xabx", "x"), ("q", "x"), ("z", "x"), (None, "x")], "m string, k string")
    found = first_match(rules, {"m": F.col("m"), "k": F.col("k")})
    got = [tuple(r) for r in df.select(found, apply_if_found(found, F.lit("cur")), apply_if_missing(found, F.lit("kept"), "nomap")).collect()]
    assert got == [("first", "first", "kept"), ("second", "second", "kept"), (None, "cur", "kept"), (None, "cur", "kept")]


def test_allocation_groups(spark):
    groups = AG.group_table(spark.createDataFrame(
        [("1 {Acura_MDX}", 1), ("2 {ACURA_MDX}", 2), ("3 {Cadillac_ESC}", 3), ("4 {Jeep_WRNGLR SPR}", 4), ("5 {Lexus_RX 350H}", 5), ("6 {x", 6)],
        "e string, p int"), "e", "p")
    vans = spark.createDataFrame([("V1", "9 {van}")], "model_id string, group_code string")
    models = [
        ("Acura", "mdx ", "a", "st", "t"), ("Cadillac", "Escalade ESV", "a", "st", "t"), ("Jeep", "Wrangler", "a", "st", "Sport S"),
        ("Lexus", "RX", "a", "RX 350 Premium", "t"), ("Mercedes-Benz", "Sprinter 2500", "v1", "st", "t"), ("Ram", "1500 Classic", "a", "st", "t"),
        ("Chevrolet", "Silverado 2500HD", "a", "Crew Cab 4WD", "t"), ("Ford", "Focus", "a", "st", "t"), ("McLaren", "P1", "a", "st", "t"),
        ("Toyota", "Corolla", "a", "Hybrid LE", "t"),
    ]
    df = spark.createDataFrame(models, "make string, model string, model_id string, style_name string, trim string")
    got = {r.model: r.allocation_group for r in AG.assign_allocation_group(df, groups, vans).collect()}
    assert got == {
        "mdx ": "2 {ACURA_MDX}", "Escalade ESV": "3 {Cadillac_ESC}", "Wrangler": "4 {Jeep_WRNGLR SPR}", "RX": "5 {Lexus_RX 350H}",
        "Sprinter 2500": "9 {van}", "1500 Classic": "2361 {Ram_CREWPRM}", "Silverado 2500HD": "1466 {Chevrolet_CHDCRW}", "Focus": "nomap",
        "Corolla": "2453 {Toyota_COROLLA HYBRID}",
    }
    pipeline = {r.model: r.allocation_group for r in AG.assign_allocation_group(df, groups, vans, special=False).collect()}
    assert (pipeline["1500 Classic"], pipeline["RX"]) == ("nomap", "nomap")


def test_rules_as_a_table(spark):
    """The join finds what the expression finds; a rule behind a wider one is shadowed."""
    columns = ["make", "model", "style"]
    shadowed = Rule("never", has={"model": ("YUKON",), "style": ("SLT",)}, is_any={"make": ("GMC",)})
    lacking = Rule("other", lacks={"style": ("REG",), "model": ("X",)}, is_any={"make": ("FORD", "RAM")})
    rules = [*AG.MODEL_ABBREVIATIONS, *AG.SPECIAL_GROUPS, shadowed, lacking]
    makes, models = ["gmc", "Cadillac ", "JEEP", "FORD", "Ram", None, ""], ["Yukon XL", "Yukon", "ESCALADE ESV", "Grand", "1500", "Focus", None]
    data = [(a, b, c, i) for i, (a, b, c) in enumerate((a, b, c) for a in makes for b in models for c in ("SLT", "Reg Cab", None))]
    df = spark.createDataFrame(data, "make string, model string, style string, id int")
    table = RU.match_by_table(df, rules, columns, "found").withColumn("wanted", first_match(rules, {c: F.col(c) for c in columns}))
    assert table.count() == len(data) and table.where("not found <=> wanted").collect() == []
    report = {r["priority"]: (r["result"], r["matched"], r["won"]) for r in RU.rule_report(df, rules, columns).collect()}
    assert len(report) == len(rules) and report[len(rules) - 2] == ("never", 2, 0) and report[len(rules) - 1][2] > 0
    assert sum(won for _, _, won in report.values()) == table.where("found is not null").count()


def test_market_cubes(spark, rows):
    current = spark.createDataFrame(
        [("M", "FORD", "1", None, "D1", 2025, 1, 10), ("M", "FORD", "1", "", "", 2025, 3, 30), ("M", "FORD", "2", "S2", "D2", 2025, 3, 10),
         ("M", "FORD", "2", "S2", "D2", 2024, 2, 99), ("M", "XX", "2", "S2", "D2", 2025, 3, 99)],
        "market_name string, make string, site_code string, own_store string, selling_dealer string, sale_year int, sale_month int, mtd_sales long")
    history = current.filter("sale_year = 2024").withColumn("mtd_sales", F.lit(7).cast("long"))
    dims = {
        "allowed": spark.createDataFrame([("M", "FORD"), ("M", "FORD")], "market_name string, make string"),
        "market": spark.createDataFrame([("M", "GM1")], "market_name string, group_market string"),
        "brand": spark.createDataFrame([("FORD", "Ford")], "make string, brand_group string"),
        "override": spark.createDataFrame([("1", "S1", "Over")], "site_code string, own_store_override string, selling_dealer_override string"),
    }
    as_of = date(2025, 3, 15)
    sales = MK.prepare_sales(current, history, dims, as_of)
    monthly = MK.monthly_cube(sales)
    assert rows(monthly, "store_num", "selling_dealer", "year", "time", "mtd_sales", "share_pct", "comp_sales", "own_sales") == [
        ("", "D1", 2025, 1, 10, 1.0, 10, 0), ("S1", "Over", 2025, 3, 30, 0.75, 0, 30), ("S2", "D2", 2024, 2, 7, 1.0, 0, 7),
        ("S2", "D2", 2025, 3, 10, 0.25, 0, 10),
    ]
    ytd = MK.ytd_cube(sales, as_of)
    assert ("Competition", "YTDFeb", 2025, 10) in rows(ytd, "store_num", "time", "year", "ytd_sales")
    assert ("S1", "YTDMar", 2025, 30, 0.6) in rows(ytd, "store_num", "time", "year", "ytd_sales", "share_pct")


def test_monthly_cube_shuffles_sales_for_its_sums_alone(spark):
    """Sales are shuffled for the sums of the grain and of the entities, not to meet lists and totals that are small, and a
    stored step leaves no shuffle files behind."""
    from pathlib import Path

    from lotwise.session import written

    data = [("M", f"B{i % 5}", str(i % 40), None if i % 3 else "", f"D{i % 7}", 2025, 1 + i % 2, i) for i in range(400)]
    history = spark.createDataFrame(
        data, "market_name string, make string, site_code string, own_store string, selling_dealer string, sale_year int, sale_month int, mtd_sales long")
    pairs = history.groupBy("market_name", "make").agg(F.count(F.lit(1)).alias("n")).select("market_name", "make")
    dims = {
        "allowed": pairs,
        "market": spark.createDataFrame([("M", "GM1")], "market_name string, group_market string"),
        "brand": history.select("make").distinct().withColumn("brand_group", F.lit("Ford")),
        "override": spark.createDataFrame([(str(i), "S1", "Over") for i in range(40)], "site_code string, own_store_override string, selling_dealer_override string"),
    }
    before = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None)
    sales = MK.prepare_sales(history.limit(0), history, dims, date(2025, 3, 15))
    cube = MK.monthly_cube(sales)
    for df in (sales, cube):  # sums and lists are stored: what follows reads tables
        assert "Aggregate" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert "Exchange hashpartitioning" not in cube._jdf.queryExecution().executedPlan().toString()
    assert sum(r["mtd_sales"] for r in cube.collect()) == sum(range(400))
    assert {(r["make_market_sales"]) for r in cube.where("time = 1").collect()} == {sum(i for i in range(400) if i % 5 == b and i % 2 == 0) for b in range(5)}

    def files():
        root = Path(spark._jsc.sc().env().blockManager().diskBlockManager().localDirsString()[0])
        return {p for p in root.rglob("shuffle_*.data")}

    there = files()
    sums = written(history.groupBy("site_code").agg(F.sum("mtd_sales").alias("n")), "sums")
    assert files() <= there and sums.count() == 40
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) == before


def test_split_credit_without_first_name(spark, rows):
    df = spark.createDataFrame([(None, "b", 4.0), (None, None, 2.0), ("a", "b", 1.0)], "a1 string, a2 string, n double")
    assert rows(MT.split_credit(df, "a1", "a2", "n", "who"), "who", "n") == [("a", 0.5), ("b", 0.5), ("b", 2.0)]


def test_dense_brand_inventory_of_all_months(spark, rows):
    from lotwise.plans.inventory import dense_brand_inventory

    inventory = spark.createDataFrame(
        [(date(1995, 1, 1), "Ford", "300", "S", 2), (date(2031, 5, 1), "Ford", "300", "S", 3)],
        "accounting_month date, make string, department string, status string, inventory_count int",
    )
    sales = spark.createDataFrame([(date(2031, 5, 1), "Ford", "New", 4)], "accounting_month date, make string, department string, sold_count int")
    dense = dense_brand_inventory(inventory, sales)
    assert rows(dense.where("brand = 'Ford'"), "date", "inv", "sales") == [(date(1995, 1, 1), 2, 0), (date(2031, 5, 1), 3, 4)]


def test_year_to_date_rows_fan_out_after_the_shuffle(spark):
    df = spark.createDataFrame([("a", 2024, 2, 5), ("a", 2024, 2, None), ("a", 2024, 9, 1), ("b", 2024, 3, None)], "k string, y int, m int, v int")
    got = MS.ytd_by_month(df, ["k", "y"], "m", "v", date(2025, 3, 20), "ytd", "time")
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [("a", 2024, 5, "YTDFeb"), ("a", 2024, 5, "YTDMar"), ("b", 2024, None, "YTDMar")]))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Aggregate")
