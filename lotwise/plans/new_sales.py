"""New sales by comparison period, the brand tracker and the portfolio stack."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import classify as C
from ..functions import dates as D
from ..functions.text import first_cap
from ..operators.intervals import sums_in_intervals
from ..operators.measures import per_unit, sum_when, total_nonzero
from ..operators.predicates import ci_equal, ci_not_in, not_like_any
from ..operators.stacking import fill_placeholders, stack_facts

EXCLUDED_MARKETS = ("market 97", "market 98")


def assign_periods(df: DataFrame, day: str, periods: Sequence[tuple[str, date, date]]) -> DataFrame:
    """One row per period that holds the day.  The few named periods are an array literal
    whose matching entries are exploded, so there is no range join."""
    entries = F.array(
        *[F.struct(F.lit(n).alias("period"), F.lit(s).alias("start_date"), F.lit(e).alias("end_date")) for n, s, e in periods]
    )
    hits = F.filter(entries, lambda p: F.to_date(F.col(day)).between(p["start_date"], p["end_date"]))
    first, last = min(s for _, s, _ in periods), max(e for _, _, e in periods)
    return (
        df.filter(F.col(day).between(F.lit(first), F.lit(last)))
        .withColumn("_period", F.explode(hits))
        .select("*", "_period.*")
        .drop("_period")
    )


def sales_by_period(sales: DataFrame, as_of: date) -> DataFrame:
    """New sales of four overlapping periods per brand; gross only from booked records."""
    booked = ci_equal(F.col("record_source"), "accounting")
    rows = assign_periods(
        sales.filter(ci_equal(F.col("department"), "new")), "contract_date", D.comparison_periods(as_of)
    )
    table = rows.groupBy(
        "period", "start_date", "end_date",
        C.brand_group(F.col("make"), "spine").alias("brand"), C.segment(F.col("make"), "spine").alias("category"),
    ).agg(
        F.sum("sold_count").alias("sold_count"),
        sum_when(booked, F.col("base_retail")).alias("base_gross"),
        sum_when(booked, F.col("incentives")).alias("incentive_gross"),
        sum_when(booked, F.col("fi_gross")).alias("cfs_gross"),
        sum_when(booked, F.col("ovi")).alias("ovi_gross"),
        sum_when(booked, F.col("sold_count")).alias("accounting_sold_count"),
    )
    parts = [F.col(c) for c in ("sold_count", "base_gross", "incentive_gross", "cfs_gross", "ovi_gross")]
    return table.filter(total_nonzero(*parts)).select(
        F.col("end_date").alias("date"), "period", "brand", "category",
        "sold_count", "base_gross", "incentive_gross", "cfs_gross", "ovi_gross", "accounting_sold_count",
    )


def sales_by_store_period(sales: DataFrame, periods: DataFrame) -> DataFrame:
    """New sales of every store's own periods, however many there are and whether or not they overlap.

    ``periods``: store_id, period, start_date, end_date.  Gross counts booked records only, as in
    :func:`sales_by_period`; a period without a sale has no row, and a repeated period counts its sales each time.
    """
    booked = ci_equal(F.col("record_source"), "accounting")
    gross = {"base_gross": "base_retail", "incentive_gross": "incentives", "cfs_gross": "fi_gross", "ovi_gross": "ovi"}
    facts = sales.filter(ci_equal(F.col("department"), "new")).select(
        "store_id", "contract_date", "sold_count", *[F.when(booked, F.col(c)).otherwise(0).alias(n) for n, c in gross.items()],
    )
    return sums_in_intervals(
        facts, "contract_date", ["sold_count", *gross], periods, "start_date", "end_date", ["store_id"]
    ).drop("rows")


def store_brand(stores: DataFrame, regions: Sequence[str], excluded_names: Sequence[str]) -> DataFrame:
    """Brand of each open retail store."""
    return stores.filter(
        ci_equal(F.col("store_status"), "open") & F.col("region_name").isin(*regions)
        & not_like_any(F.col("store_name"), excluded_names) & ci_equal(F.col("store_type"), "store")
    ).select("store_id", C.brand_group(F.col("manufacturer_name"), "tracker_store").alias("brand"))


def brand_tracker(
    inventory: DataFrame, sales: DataFrame, stores: DataFrame, as_of: date,
    offsets: Mapping[str, int] = D.PERIOD_OFFSETS, excluded_markets: Sequence[str] = EXCLUDED_MARKETS,
    excluded_brands: Sequence[str] = ("Lamborghini", "Bentley", "Aston Martin"),
) -> DataFrame:
    """Inventory, aged units, sales and gross per unit by store and brand: this month, the
    month before and a year ago.  Pass the month-end offsets for the closed-month variant."""
    base = D.month_start(as_of)
    month = F.col("accounting_month")
    inv = (
        inventory.filter(
            D.period_filter(month, F.col("status"), as_of, offsets) & (F.col("department") == "300")
            & ci_not_in(F.col("market_name"), excluded_markets)
        )
        .groupBy("accounting_month", "store_id", "store_name", C.brand_group(F.col("make"), "tracker").alias("brand"), "make")
        .agg(
            F.sum("inventory_count").alias("inv_total"),
            sum_when(F.col("days_in_inventory_group") > 90, F.col("inventory_count")).alias("aged_inv_count"),
        )
        .filter(F.col("inv_total") != 0)
        .drop("make")
    )
    prior, year_ago = D.add_months(base, offsets["PM"]), D.add_months(base, offsets["PY"])
    recent = (month >= F.lit(prior)) & (month != F.lit(D.add_months(base, 1)))
    booked = ci_equal(F.col("record_source"), "accounting")
    # One pass: unbooked or year-ago rows add to the units only, booked recent rows to the gross.
    gross = booked & recent
    sold = (
        sales.filter(ci_equal(F.col("department"), "new") & (recent | (month == F.lit(year_ago))))
        .groupBy("accounting_month", "store_id", "store_name")
        .agg(
            F.sum("sold_count").alias("sold_count"),
            F.sum(F.when(gross, F.col("base_retail"))).alias("base_gross"),
            F.sum(F.when(gross, F.col("front_gross"))).alias("front_gross"),
            F.sum(F.when(gross, F.col("sold_count"))).alias("accounting_sold_count"),
        )
        .join(stores, "store_id", "left")
        .groupBy("accounting_month", "store_id", "store_name", "brand")
        .agg(*[F.sum(c).alias(c) for c in ("sold_count", "base_gross", "front_gross", "accounting_sold_count")])
        .filter(F.col("sold_count") != 0)
    )
    stacked = stack_facts([inv, sold]).filter(ci_not_in(F.col("brand"), excluded_brands))
    table = stacked.groupBy("accounting_month", "store_id", "store_name", "brand").agg(
        F.sum("inv_total").alias("inv_total"),
        F.sum("aged_inv_count").alias("aged_inv_count"),
        *[F.sum(c).alias(c) for c in ("sold_count", "base_gross", "front_gross", "accounting_sold_count")],
    )
    return (
        table.withColumn("period", D.period_label(month, as_of, dict(offsets)))
        .withColumn("base_pvr", per_unit(F.col("base_gross"), F.col("sold_count")))
        .withColumn("core_pvr", per_unit(F.col("front_gross"), F.col("sold_count")))
    )


PORTFOLIO_KEYS = [
    "accounting_month", "market_name", "store_name", "department", "style_name", "fuel_type", "make", "model", "trim",
    "mileage", "store_id", "days_in_inventory_group", "days_in_inventory_store", "loaner", "msrp_adv",
    "allocation_group", "exterior_color", "status", "balance", "ex_service",
]
PORTFOLIO_MEASURES = [
    "inv_count", "sum_sold", "sum_front_gross", "sum_fi_gross", "sum_incentive_gross", "sum_ovi_gross",
    "in_transit_count", "pipeline_count",
]


def portfolio_stack(
    inventory: DataFrame, sales: DataFrame, orders_month: DataFrame, orders_daily: DataFrame, as_of: date,
    months: int = 37, min_model_year: int = 2020,
) -> DataFrame:
    """Inventory, sales, in-transit and pipeline units of the last months in one table.

    Order snapshots count at quarter ends and in the closed months of the current quarter;
    the current month comes from yesterday's daily snapshot.
    """
    end = D.month_start(as_of)
    start = D.add_months(end, -months)
    window = F.col("accounting_month").between(F.lit(start), F.lit(end))
    markets = ci_not_in(F.col("market_name"), EXCLUDED_MARKETS)
    inv_keys = [k for k in PORTFOLIO_KEYS if k != "ex_service"]
    stock = (
        inventory.filter(window & markets & (F.col("department") == "300"))
        .groupBy(*inv_keys)
        .agg(F.sum("inventory_count").alias("inv_count"))
        .filter(F.col("inv_count") > 0)
        .withColumn("table_source", F.lit("Inventory_Table"))
    )
    sale_keys = ["accounting_month", "market_name", "store_name", "department", "style_name", "fuel_type", "make",
                 "model", "trim", "mileage", "store_id", "ex_service"]
    sold = (
        sales.filter(window & markets & (F.col("model_year") > min_model_year) & ci_equal(F.col("department"), "new"))
        .groupBy(*sale_keys)
        .agg(
            F.sum("sold_count").alias("sum_sold"), F.sum("front_gross").alias("sum_front_gross"),
            F.sum("fi_gross").alias("sum_fi_gross"), F.sum("incentives").alias("sum_incentive_gross"),
            F.sum("ovi").alias("sum_ovi_gross"),
        )
        .withColumn("table_source", F.lit("Sales_Table"))
    )
    monthly = orders_month.withColumn("accounting_month", D.year_month_to_date(F.col("time_period"))).filter(
        (F.col("accounting_month") >= F.lit(start)) & D.quarter_months(F.col("accounting_month"), as_of)
        & F.col("make").isNotNull()
    )
    daily = orders_daily.filter(
        (F.col("update_date") == F.lit(as_of - timedelta(days=1))) & F.col("make").isNotNull()
    ).withColumn("accounting_month", F.lit(end))

    def orders(df: DataFrame, prefix: str) -> DataFrame:
        # One aggregate yields both counts; the label splits them into two kinds of rows.
        transit = ci_equal(F.col("status"), "in transit")
        label = F.when(transit, f"{prefix}In Transit").otherwise(f"{prefix}Pipeline")
        counted = (
            df.filter(ci_not_in(F.col("status"), ["ignore", "cancelled"]))
            .groupBy("accounting_month", first_cap(F.col("make")).alias("make"), "store_id", label.alias("table_source"))
            .agg(F.count(F.lit(1)).alias("_n"))
        )
        named = ["market_name", "store_name", "department", "style_name", "fuel_type", "model", "trim", "ex_service"]
        is_transit = F.col("table_source").endswith("In Transit")
        return counted.select(
            "accounting_month", "make", "store_id", "table_source",
            *[F.col("table_source").alias(c) for c in named],
            F.when(is_transit, F.col("_n")).otherwise(0).alias("in_transit_count"),
            F.when(is_transit, 0).otherwise(F.col("_n")).alias("pipeline_count"),
        )

    blank = {k: F.lit("") for k in ("loaner", "allocation_group", "exterior_color", "status")}
    zero = {k: F.lit(0) for k in ("days_in_inventory_group", "days_in_inventory_store", "msrp_adv", "balance")}
    stacked = stack_facts(
        [
            stock.withColumn("ex_service", F.lit("")),
            sold.withColumns(blank | zero),
            orders(monthly, "").withColumns(blank | zero),
            orders(daily, "CM ").withColumns(blank | zero),
        ],
        {m: 0 for m in PORTFOLIO_MEASURES},
    )
    return stacked.select(*PORTFOLIO_KEYS, "table_source", *PORTFOLIO_MEASURES)


PIVOT_KEYS = [
    "accounting_month", "market_name", "store_name", "department", "style_name", "fuel_type", "make", "model", "trim",
    "store_id", "loaner", "allocation_group", "status", "ex_service", "table_source",
]


def portfolio_pivot(stack: DataFrame) -> DataFrame:
    """Portfolio summed over its text keys, with the selling price per unit."""
    values = ["mileage", "days_in_inventory_store", "balance", "inv_count", "sum_sold", "sum_front_gross",
              "sum_fi_gross", "sum_incentive_gross", "sum_ovi_gross"]
    filled = fill_placeholders(stack, PIVOT_KEYS, values, "NaN")
    table = filled.groupBy(*PIVOT_KEYS).agg(*[F.sum(v).alias(v) for v in values])
    ratio = F.coalesce(per_unit(F.col("sum_front_gross"), F.col("sum_sold")), F.lit(0.0))
    return table.withColumn("year", F.left("accounting_month", F.lit(4))).withColumn("asp", ratio)


FINAL_NAMES = {
    "make": "brand", "allocation_group": "model_group", "accounting_month": "sales_date", "sum_sold": "units_sold",
    "inv_count": "inventory_levels", "days_in_inventory_store": "days_on_lot",
}


def portfolio_final(pivot: DataFrame) -> DataFrame:
    """Columns of the portfolio dashboard."""
    return pivot.withColumnsRenamed(FINAL_NAMES).select(
        "brand", "model_group", "year", "market_name", "store_name", "sales_date", "units_sold", "sum_front_gross",
        "asp", "inventory_levels", "days_on_lot",
    )
