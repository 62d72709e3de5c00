"""Electric availability: inventory, orders, sales, pace and sales mix."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import classify as C
from ..functions import dates as D
from ..functions.mappings import ORDER_STATUSES
from ..functions.text import first_cap, id_cleanup
from ..operators.lookup import lookup
from ..operators.measures import group_sum, sales_mix
from ..operators.predicates import ci_equal, ci_not_in
from ..operators.stacking import stack_facts

EXCLUDED_MARKETS = ("market 97", "market 98")
COUNTS = ["inventory_count", *[column for _, column in ORDER_STATUSES.values()]]
UNIT_KEYS = ["accounting_month", "store_name", "model", "store_id", "fuel_type", "make"]


def _orders(df: DataFrame, prefix: str) -> DataFrame:
    """Orders per status; the status name stands in for store name and fuel type, so these
    rows never meet the sales of the same key."""
    status = F.upper("status")
    label = C.map_values(status, {code: prefix + name for code, (name, _) in ORDER_STATUSES.items()})
    counts = [F.count(F.when(status == code, 1)).alias(col) for code, (_, col) in ORDER_STATUSES.items()]
    return (
        df.filter(F.col("make").isNotNull() & status.isin(*ORDER_STATUSES))
        .groupBy(
            "accounting_month", label.alias("store_name"), F.col("alloc_group").alias("model"), "store_id",
            label.alias("fuel_type"), first_cap(F.col("make")).alias("make"),
        )
        .agg(*counts)
    )


def availability(
    inventory: DataFrame, sales: DataFrame, orders_month: DataFrame, orders_daily: DataFrame, as_of: date,
    start: date, excluded_region: str,
) -> DataFrame:
    """Inventory, orders by status and sales per month, store, model, fuel and make."""
    current = D.month_start(as_of)
    month = F.col("accounting_month")
    sold = (
        sales.filter(
            (month >= F.lit(start)) & ci_equal(F.col("department"), "new")
            & ci_not_in(F.col("market_name"), EXCLUDED_MARKETS) & F.col("make").isNotNull()
        )
        .groupBy(
            month, "store_name", F.col("allocation_group").alias("model"), "store_id", "fuel_type",
            first_cap(F.col("make")).alias("make"),
        )
        .agg(F.sum("sold_count").alias("sales_count"))
    )
    stock = (
        inventory.filter(
            (month >= F.lit(start)) & (F.upper("region_name") != excluded_region.upper())
            & ci_not_in(F.col("market_name"), EXCLUDED_MARKETS) & (F.col("department") == "300")
            & F.col("status").isNotNull() & F.col("make").isNotNull()
            & ~((month == F.lit(current)) & (F.upper("status") == "G"))
        )
        .groupBy(
            month, "store_name", F.col("allocation_group").alias("model"), "store_id", "fuel_type",
            first_cap(F.col("make")).alias("make"),
        )
        .agg(F.sum("inventory_count").alias("inventory_count"))
    )
    by_month = orders_month.withColumn("accounting_month", D.year_month_to_date(F.col("time_period"))).filter(
        month >= F.lit(start)
    )
    yesterday = orders_daily.filter(F.col("update_date") == F.lit(as_of - timedelta(days=1))).withColumn(
        "accounting_month", F.lit(current)
    )
    stacked = stack_facts([stock, _orders(by_month, ""), _orders(yesterday, "CM_")], {c: 0 for c in COUNTS})
    combined = group_sum(stacked, UNIT_KEYS, COUNTS)
    # The store's name is left out of the sales key: orders carry a status name there.
    keys = ["accounting_month", "model", "store_id", "fuel_type", "make"]
    return (
        combined.join(sold.drop("store_name"), keys, "left")
        .withColumn("sales_count", F.coalesce("sales_count", F.lit(0)))
        .withColumn("brand_group", C.brand_group(F.col("make"), "availability"))
        .withColumn("segment", C.segment(F.col("make"), "availability"))
    )


def electric_availability(
    available: DataFrame, stores: DataFrame, fuel_list: DataFrame, pace: DataFrame, mix: DataFrame, start: date
) -> DataFrame:
    """Electric models of the current and the prior month; the current one with its expected
    pace, the store's pace times the model's share of last month's sales.

    ``stores``: store_id, store_name.  ``fuel_list``: model, ev_flag.  ``pace``: store_id,
    pace (text).  ``mix``: output of :func:`prior_month_mix`.
    """
    named = available.drop("store_name").join(stores, "store_id", "left")
    flagged = lookup(named, fuel_list, ["model"], ["ev_flag"]).filter(F.col("ev_flag") == "EV")
    label = F.when(F.col("accounting_month") == F.lit(start), "Prior Month").otherwise("Current Month")
    keys = ["month", "store_name", "brand_group", "store_id", "model", "make"]
    summed = group_sum(flagged.withColumn("month", label), keys, [*COUNTS, "sales_count"], drop_null_keys=True)
    summed = summed.withColumn("store_id", id_cleanup(F.col("store_id")))
    paces = pace.select(id_cleanup(F.col("store_id")).alias("store_id"), F.col("pace").try_cast("double").alias("pace"))
    shares = mix.select(
        id_cleanup(F.col("store_id")).alias("store_id"), F.trim("allocation_group").alias("model"), "sales_mix"
    )
    # Both months take the lookups in one pass; the prior month's figures are blanked afterwards.
    paced = lookup(lookup(summed, paces, ["store_id"], ["pace"], 0.0), shares, ["store_id", "model"], ["sales_mix"], 0.0)
    is_current = F.col("month") == "Current Month"
    return (
        paced.withColumn("pace", F.when(is_current, F.col("pace")).otherwise(0.0))
        .withColumn("sales_mix", F.when(is_current, F.col("sales_mix")).otherwise(0.0))
        .withColumn("pace_by_model", F.col("pace") * F.col("sales_mix"))
    )


def prior_month_mix(sales: DataFrame, as_of: date) -> DataFrame:
    month = D.add_months(D.month_start(as_of), -1)
    rows = sales.filter(
        (F.col("accounting_month") == F.lit(month)) & ci_equal(F.col("department"), "new")
        & ci_equal(F.col("record_source"), "accounting") & F.col("make").isNotNull()
    )
    return sales_mix(rows, "store_id", ["make", "allocation_group"], "sold_count")
