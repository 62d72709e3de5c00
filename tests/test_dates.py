from datetime import date

from pyspark.sql import functions as F

from lotwise.functions import dates as D


def test_month_arithmetic():
    assert D.add_months(date(2025, 3, 31), -1) == date(2025, 2, 28)
    assert D.add_months(date(2025, 12, 15), 1) == date(2026, 1, 15)
    assert D.quarter_start(date(2025, 8, 20)) == date(2025, 7, 1)


def test_cutover():
    assert D.reporting_month(date(2025, 6, 5), 6) == date(2025, 5, 1)
    assert D.reporting_month(date(2025, 6, 6), 6) == date(2025, 6, 1)
    assert D.reporting_day(date(2025, 6, 7), 8) == date(2025, 5, 31)
    assert D.closed_month(date(2025, 6, 6)) == date(2025, 5, 1)
    assert D.closed_month(date(2025, 6, 5)) == date(2025, 4, 1)


def test_last_week():
    assert D.last_week(date(2025, 6, 11)) == (date(2025, 6, 2), date(2025, 6, 8))
    assert D.last_week(date(2025, 6, 9)) == (date(2025, 6, 2), date(2025, 6, 8))


def test_comparison_periods_overlap():
    periods = {name: (start, end) for name, start, end in D.comparison_periods(date(2025, 6, 20))}
    assert periods == {
        "PM": (date(2025, 5, 1), date(2025, 5, 19)),
        "IN-BETWEEN-1": (date(2025, 5, 1), date(2025, 5, 27)),
        "CM": (date(2025, 6, 1), date(2025, 6, 19)),
        "IN-BETWEEN-2": (date(2025, 6, 1), date(2025, 6, 13)),
    }


def test_columns(spark):
    months = [date(2025, m, 1) for m in range(1, 9)] + [date(2024, 9, 1), date(2024, 10, 1), date(2024, 8, 1)]
    df = spark.createDataFrame([(m, "S") for m in months] + [(date(2025, 8, 1), "G")], "m date, s string")
    as_of = date(2025, 8, 20)
    got = {r.m for r in df.filter(D.quarter_months(F.col("m"), as_of)).collect()}
    assert got == {date(2025, 3, 1), date(2025, 6, 1), date(2025, 7, 1), date(2024, 9, 1)}
    labels = {r.m: r.p for r in df.select("m", D.period_label(F.col("m"), as_of).alias("p")).collect()}
    assert (labels[date(2025, 7, 1)], labels[date(2025, 8, 1)], labels[date(2024, 8, 1)]) == ("PM", "CM", "PY")
    assert labels[date(2025, 1, 1)] == "ERROR"
    kept = df.filter(D.period_filter(F.col("m"), F.col("s"), as_of)).collect()
    assert {(r.m, r.s) for r in kept} == {(date(2025, 7, 1), "S"), (date(2025, 8, 1), "S"), (date(2024, 8, 1), "S")}


def test_period_text(spark):
    df = spark.createDataFrame([("202506",), ("2025",), (None,)], "p string")
    got = [r[0] for r in df.select(D.year_month_to_date(F.col("p"))).collect()]
    assert got == [date(2025, 6, 1), None, None]
    quarters = spark.createDataFrame([(date(2025, 12, 1),), (None,)], "d date").select(D.quarter_label(F.col("d"))).collect()
    assert [r[0] for r in quarters] == ["Q4", "Unk"]
