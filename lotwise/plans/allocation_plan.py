"""Plan figures: earned, committed and forecast units from the planning tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import classify as C
from ..functions.mappings import PLAN_CODES
from ..operators.measures import cap, pivot_sum
from ..operators.stacking import union_distinct

ENTRY_COLUMNS = ["year", "month", "dealer_vehicle_id", "mth", "column_code", "entered_value", "status_id"]
MEASURES = {
    "Earned_M1": "earned_m1", "Commit_M1": "commit_m1", "Fcast_M1": "fcast_m1", "Fcast_M2": "fcast_m2",
    "Fcast_M3": "fcast_m3", "Net_Add": "net_add",
}
ALL_CODES = [code for codes in PLAN_CODES.values() for code in codes]


def plan_fact(entries: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Plan entries with make, model and dealer: an inner-join star over six dimensions.

    ``dims``: vehicles, brands, models, dealers, cores, sorts.  The core table works as a
    filter on (vehicle, year, month) and the sort table on the model; both keep their inner
    joins, because a repeated row multiplies the fact in the source reports as well.
    """
    return (
        entries.join(dims["vehicles"], "dealer_vehicle_id")
        .join(dims["brands"], "brand_id")
        .join(dims["models"], ["brand_model_id", "brand_id"])
        .join(dims["dealers"], "dealer_code")
        .join(dims["cores"], ["dealer_vehicle_id", "year", "month"])
        .join(dims["sorts"], "brand_model_id")
    )


def commits_and_forecasts(
    commits: DataFrame, forecasts: DataFrame, codes: Sequence[str], months: Sequence[tuple[int, int]] | None,
    since_year: int | None = None,
) -> DataFrame:
    """Distinct union of both entry tables, cut to the wanted codes and months before it shuffles."""

    def wanted(df: DataFrame) -> DataFrame:
        rows = df.select(*ENTRY_COLUMNS).filter(F.col("column_code").isin(list(codes)) & (F.col("entered_value") != 0))
        if since_year is not None:
            rows = rows.filter(F.col("year") >= since_year)
        if months is not None:
            test = F.lit(False)
            for year, month in months:
                test = test | ((F.col("year") == year) & (F.col("month") == month))
            rows = rows.filter(test)
        return rows

    return union_distinct(wanted(commits), wanted(forecasts))


def plan_by_model(
    commits: DataFrame, forecasts: DataFrame, dims: Mapping[str, DataFrame], months=None, since_year=None
) -> DataFrame:
    """Measures per year, month, dealer, make and model."""
    entries = commits_and_forecasts(commits, forecasts, ALL_CODES, months, since_year)
    coded = plan_fact(entries, dims).withColumn("measure", C.plan_measure(F.col("column_code")))
    wide = pivot_sum(
        coded, ["year", "month", "dealer_code", "brand_code", "brand_model_code"], "measure", "entered_value", MEASURES
    )
    return wide.withColumn("turned_down", F.col("earned_m1") - F.col("commit_m1"))


def plan_rollup(by_model: DataFrame, capped: bool = True, keep_model: bool = False, keep_period: bool = False) -> DataFrame:
    """Earned and committed units per parent brand, segment and store; commits above the
    earned units count as earned.  Rows outside the segments are left out."""
    keys = [*(["year", "month"] if keep_period else []), "parent_brand", "segment", "dealer_code",
            *(["brand_model_code"] if keep_model else [])]
    rolled = (
        by_model.withColumn("parent_brand", C.brand_group(F.col("brand_code"), "plan"))
        .withColumn("segment", C.segment(F.col("brand_code"), "plan"))
        .filter(F.col("segment").isNotNull())
        .groupBy(*keys)
        .agg(F.sum("earned_m1").alias("earned_m1"), F.sum("commit_m1").alias("commit_m1"))
    )
    if capped:
        rolled = rolled.withColumn("commit_m1", cap(F.col("commit_m1"), F.col("earned_m1")))
    return rolled


def plan_weekly(commits: DataFrame, forecasts: DataFrame, dims: Mapping[str, DataFrame], as_of: date) -> DataFrame:
    """Earned and committed units of the current month per brand and segment, uncapped."""
    codes = [*PLAN_CODES["Commit_M1"], *PLAN_CODES["Earned_M1"]]
    entries = commits_and_forecasts(commits, forecasts, codes, [(as_of.year, as_of.month)])
    coded = plan_fact(entries, dims).withColumn("measure", C.plan_measure(F.col("column_code")))
    per_make = pivot_sum(
        coded, ["brand_code"], "measure", "entered_value", {"Earned_M1": "earned_m1", "Commit_M1": "commit_m1"}
    )
    return (
        per_make.groupBy(
            C.brand_group(F.col("brand_code"), "plan_weekly").alias("brand"),
            C.segment(F.col("brand_code"), "plan_weekly").alias("segment"),
        ).agg(F.sum("earned_m1").alias("earned_m1"), F.sum("commit_m1").alias("commit_m1"))
    )


def plan_by_brand_month(commits: DataFrame, dims: Mapping[str, DataFrame], since_year: int) -> DataFrame:
    """Committed units and net additions per brand and month."""
    codes = [*PLAN_CODES["Commit_M1"], *PLAN_CODES["Net_Add"]]
    rows = commits.select(*ENTRY_COLUMNS).filter(F.col("column_code").isin(codes) & (F.col("year") >= since_year))
    coded = plan_fact(rows, dims).withColumn("measure", C.plan_measure(F.col("column_code")))
    return pivot_sum(
        coded, ["year", "month", "brand_code"], "measure", "entered_value",
        {"Commit_M1": "commit_units", "Net_Add": "net_add"},
    )


def history_layout(rollup: DataFrame) -> DataFrame:
    """Rollup rows with the period columns of the plan history table."""
    period = F.concat(F.col("year").cast("string"), F.lpad(F.col("month").cast("string"), 2, "0"))
    return (
        rollup.withColumn("year_month", period)
        .withColumn("accounting_month", F.make_date("year", "month", F.lit(1)))
        .withColumn("segment_filter", F.col("segment"))
    )


def sales_efficiency(scorecard_extract: DataFrame, month: date) -> DataFrame:
    """Store-level sales-efficiency values of a month."""
    return scorecard_extract.filter(
        (F.col("account") == "SALES EFFICIENCY %") & (F.col("consolidated_scenario") == "ACTUAL")
        & (F.col("department") == "NEW") & (F.col("month") == F.lit(month)) & (F.col("manufacture") == "PPR")
    ).select(
        F.col("org").alias("store_id"), F.month("month").alias("month"), F.year("month").alias("year"),
        "scenario", "manufacture", "department", "account", "value",
    )
