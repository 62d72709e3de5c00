import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from lotwise.operators.intervals import assign_intervals, days_in_intervals, interval_bins, sums_in_intervals

DAY = date(1969, 12, 1)  # the bins before 1970 have negative numbers
INTERVALS = "store string, period int, s date, e date"


def made(seed: int):
    rng = random.Random(seed)
    day = lambda: DAY + timedelta(days=rng.randint(0, 400))
    store = lambda: rng.choice(["hot", "hot", "a", "b", None])
    facts = [(i, store(), day() if i % 20 else None, i % 7) for i in range(400)]
    periods = [(store(), i, start := day(), start + timedelta(days=rng.choice([0, 0, 1, 2, 3, 7, 31, 200, 3000, -1]))) for i in range(60)]
    return facts, [*periods, periods[3], ("a", 90, None, DAY), ("a", 91, DAY, None), ("b", 92, date(1, 1, 1), date(9999, 12, 31))]


def holds(fact, period, keyed=True):
    same = not keyed or (fact[1] is not None and fact[1] == period[0])
    return same and None not in (fact[2], period[2], period[3]) and period[2] <= fact[2] <= period[3]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_intervals_like_brute_force(spark, rows, seed):
    facts, periods = made(seed)
    df = spark.createDataFrame(facts, "id int, store string, day date, n int").repartition(5)
    table = spark.createDataFrame(periods, INTERVALS).repartition(3)
    got = rows(assign_intervals(df, "day", table, "s", "e", ["store"]), "id", "period")
    assert got == sorted(((f[0], p[1]) for f in facts for p in periods if holds(f, p)), key=lambda t: tuple((False, str(v)) for v in t))
    bare = assign_intervals(df, "day", table.drop("store"), "s", "e")
    assert sorted(map(tuple, bare.select("id", "period").collect())) == sorted((f[0], p[1]) for f in facts for p in periods if holds(f, p, False))
    want: dict[int, list[int]] = {}
    for f in facts:
        for p in periods:
            if holds(f, p):
                entry = want.setdefault(p[1], [0, 0])
                entry[0] += f[3]
                entry[1] += 1
    sums = sums_in_intervals(df, "day", ["n"], table, "s", "e", ["store"])
    assert {r["period"]: [r["n"], r["rows"]] for r in sums.collect()} == want


def test_an_interval_has_two_bins_at_most(spark):
    table = spark.createDataFrame([("a", n, DAY, DAY + timedelta(days=n)) for n in range(5000)], INTERVALS)
    assert interval_bins(table, "s", "e").groupBy("period").count().agg({"count": "max"}).first()[0] <= 2
    wide = interval_bins(table, "s", "e").selectExpr("max((2 << _class) / (_last - _first + 1))").first()[0]
    assert wide <= 4


def test_intervals_of_empty_tables_and_taken_names(spark):
    facts, periods = made(1)
    df, table = spark.createDataFrame(facts, "id int, store string, day date, n int"), spark.createDataFrame(periods, INTERVALS)
    assert assign_intervals(df, "day", table.limit(0), "s", "e", ["store"]).count() == 0
    assert assign_intervals(df.limit(0), "day", table, "s", "e", ["store"]).count() == 0
    with pytest.raises(ValueError, match="store"):
        assign_intervals(df, "day", table, "s", "e")


def test_many_overlapping_store_periods_need_no_nested_loop(spark):
    """10,000 periods, a third of them of one store: an equality join, and few pairs tried for an answer."""
    rng = random.Random(7)
    periods = [("hot" if i % 3 == 0 else f"s{i % 50}", i, DAY + timedelta(days=rng.randint(0, 2000)), rng.randint(0, 60)) for i in range(10_000)]
    table = spark.createDataFrame([(s, i, d, d + timedelta(days=n)) for s, i, d, n in periods], INTERVALS)
    df = spark.range(60_000).selectExpr("IF(id % 3 = 0, 'hot', 's' || id % 50) AS store", "date_add(date'1969-12-01', int(id * 7 % 2000)) AS day", "1 AS n")
    held = days_in_intervals(df, "day", table, "s", "e", ["store"])
    plan = held._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    index = interval_bins(table, "s", "e")
    days = df.selectExpr("store", "unix_date(day) AS d").distinct()
    probes = days.join(index.select("_class").distinct())
    tried = probes.join(
        index.select(F.col("store").alias("st"), F.col("_class").alias("c"), "_bin"),
        F.expr("store = st AND _class = c AND shiftright(d, _class) = _bin"),
    ).count()
    assert 0 < tried < 5 * held.count()


def test_sums_of_intervals_shuffle_no_row_per_day_and_interval(spark):
    """The days meet the intervals once; what they meet is summed before it is shuffled."""
    periods = [("a", i, DAY + timedelta(days=i % 50), 300) for i in range(500)]
    table = spark.createDataFrame([(s, i, d, d + timedelta(days=n)) for s, i, d, n in periods], INTERVALS)
    df = spark.range(4000).selectExpr("'a' AS store", "date_add(date'1969-12-01', int(id % 400)) AS day", "1 AS n")
    sums = sums_in_intervals(df, "day", ["n"], table, "s", "e", ["store"])
    plan = sums._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1
    assert {(r["n"], r["rows"]) for r in sums.collect()} == {(3010, 3010)}
    classes = interval_bins(table, "s", "e", 3).agg(F.collect_set("_class")).first()[0]
    assert classes == [9]
