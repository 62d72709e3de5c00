"""New-vehicle inventory and sales: store and brand tables, dense spine, pricing, arrivals."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import classify as C
from ..functions import dates as D
from ..functions.mappings import ELECTRIC_FUEL, SPINE_BRANDS
from ..operators.lookup import densify
from ..operators.measures import pivot_sum
from ..operators.predicates import ci_equal, ci_not_in, eligible_units
from ..operators.stacking import stack_facts

EXCLUDED_MARKETS = ("market 97", "market 98")


def inventory_vs_sales(
    inventory: DataFrame, sales: DataFrame, month: date, by_store: bool = True, electric_only: bool = False,
    min_inventory: int | None = 5,
) -> DataFrame:
    """Inventory and sales of a closed month per (store and) brand group.

    Both sides are summed per make before they are stacked, so the union carries sums only.
    """
    keys = ["accounting_month", *(["store_id", "store_name"] if by_store else []), "make"]
    units = inventory.filter((F.col("accounting_month") == F.lit(month)) & (F.col("department") == "300"))
    sold = sales.filter(
        (F.col("accounting_month") == F.lit(month))
        & ci_equal(F.col("department"), "new")
        & ci_equal(F.col("record_source"), "accounting")
    )
    if electric_only:
        units = units.filter(F.col("fuel_type") == ELECTRIC_FUEL)
        sold = sold.filter(F.col("fuel_type") == ELECTRIC_FUEL)
    inv = units.groupBy(*keys).agg(F.sum("inventory_count").alias("qty")).withColumn("type", F.lit("Inv"))
    sal = sold.groupBy(*keys).agg(F.sum("sold_count").alias("qty")).withColumn("type", F.lit("Sales"))
    facts = (
        stack_facts([inv.filter("qty <> 0"), sal.filter("qty <> 0")])
        .filter(F.col("make").isNotNull())
        .withColumn("brand", C.brand_group(F.col("make"), "rollup"))
    )
    table = pivot_sum(facts, [*keys[:-1], "brand"], "type", "qty", {"Inv": "inv", "Sales": "sales"})
    return table if min_inventory is None else table.filter(F.col("inv") > min_inventory)


def electric_flags(inventory: DataFrame, as_of: date, months: int = 6) -> DataFrame:
    """Allocation groups of the last months with their electric flag."""
    return (
        inventory.filter(D.last_months(F.col("accounting_month"), months, as_of) & (F.col("department") == "300"))
        .select("allocation_group", C.ev_flag(F.col("fuel_type")).alias("ev_flag"))
        .distinct()
    )


def dense_brand_inventory(inventory: DataFrame, sales: DataFrame, months: Sequence[date] | None = None) -> DataFrame:
    """Inventory and sales of every spine brand on every month that has inventory, 0 where absent.

    ``months`` restricts both sides; without it all months take part.
    Summed per (month, brand) first: the spine and both sides are a few hundred rows.
    """
    chosen = F.col("accounting_month").isNotNull() if months is None else F.col("accounting_month").isin(list(months))
    keys = ["accounting_month", "brand", "category"]
    labelled = lambda df: df.withColumn("brand", C.brand_group(F.col("make"), "spine")).withColumn(
        "category", C.segment(F.col("make"), "spine")
    )
    units = labelled(
        inventory.filter(chosen & (F.col("department") == "300") & (F.upper("status") != "G"))
    )
    inv = units.groupBy(*keys).agg(F.sum("inventory_count").alias("_inv"))
    sold = (
        labelled(sales.filter(chosen & ci_equal(F.col("department"), "new")))
        .groupBy(*keys)
        .agg(F.sum("sold_count").alias("_sold"))
    )
    spine = densify(inv, "accounting_month", "brand", SPINE_BRANDS)
    on = ["accounting_month", "brand"]
    return (
        spine.join(inv.withColumnRenamed("category", "_inv_category"), on, "left")
        .join(sold.withColumnRenamed("category", "_sales_category"), on, "left")
        .select(
            "brand",
            F.coalesce("_sales_category", "_inv_category", F.lit("Others")).alias("category"),
            F.col("accounting_month").alias("date"),
            F.coalesce("_inv", F.lit(0)).alias("inv"),
            F.coalesce("_sold", F.lit(0)).alias("sales"),
        )
    )


def others_last(df: DataFrame) -> DataFrame:
    return df.orderBy("date", F.when(F.col("brand") == "Others", 999).otherwise(1), "brand")


def pricing(inventory: DataFrame, month: date, excluded_region: str) -> DataFrame:
    """Priced new units of a month with discounts, incentives and aged flags; no shuffle at all."""
    units = eligible_units(
        inventory.filter(
            (F.col("accounting_month") == F.lit(month)) & (F.col("department") == "300") & (F.col("inventory_count") != 0)
        ),
        EXCLUDED_MARKETS,
        excluded_region,
    )
    msrp, web, ecom, net = (F.col(c) for c in ("msrp", "price_tier_93", "price_tier_95", "price_tier_99"))
    discounted = C.is_discounted(web, ecom, msrp)
    aged = F.coalesce(F.col("days_in_inventory_group") > 90, F.lit(False))
    count = F.col("inventory_count")
    return units.select(
        "accounting_month", "vin", "inventory_count", "store_name", "make", "days_in_inventory_group", "msrp",
        "price_tier_93", "price_tier_95", "price_tier_99",
        discounted.cast("int").alias("is_discounted"),
        (msrp - web).alias("website_discount"),
        (msrp - ecom).alias("ecom_discount"),
        (ecom - net).alias("incentives"),
        ((msrp - ecom) + (ecom - net)).alias("total_discount"),
        aged.cast("int").alias("is_aged"),
        F.when(aged, count).otherwise(0).alias("aged_count"),
        F.when(aged & discounted, count).otherwise(0).alias("aged_and_discounted"),
        F.when(aged & ~discounted, count).otherwise(0).alias("aged_not_discounted"),
        C.brand_group(F.col("make"), "spine").alias("brand"),
        C.segment(F.col("make"), "spine").alias("category"),
    )


def arrivals_inventory(inventory: DataFrame, start: date, end: date) -> DataFrame:
    return (
        inventory.filter(
            (F.col("department") == "300") & (F.col("balance") > 0) & (F.col("inventory_count") > 0)
            & F.col("accounting_month").between(F.lit(start), F.lit(end))
        )
        .groupBy("accounting_month", "make", "model", "status", "entry_date", "store_name")
        .agg(F.sum("inventory_count").alias("inventory_count"))
    )


def arrivals_sales(sales: DataFrame, start: date, end: date) -> DataFrame:
    return (
        sales.filter(
            ci_equal(F.col("department"), "new") & (F.col("sold_count") != 0)
            & F.col("accounting_month").between(F.lit(start), F.lit(end))
        )
        .groupBy("accounting_month", "ex_service", "make", "record_source", "store_name")
        .agg(F.sum("sold_count").alias("sold_mtd"))
    )


def sold_by_service(sales: DataFrame, as_of: date) -> DataFrame:
    month = D.month_start(as_of)
    return (
        sales.filter((F.col("accounting_month") == F.lit(month)) & ci_equal(F.col("department"), "new"))
        .groupBy("ex_service")
        .agg(F.sum("sold_count").alias("sold_mtd"))
    )


def inventory_by_status(inventory: DataFrame, as_of: date) -> DataFrame:
    month = D.month_start(as_of)
    return (
        inventory.filter(
            (F.col("accounting_month") == F.lit(month)) & (F.col("balance") != 0) & (F.col("department") == "300")
        )
        .groupBy("status", "accounting_month")
        .agg(F.sum("inventory_count").alias("inventory_count"))
    )


def pipeline_by_status(orders_daily: DataFrame, as_of: date) -> DataFrame:
    """Orders on yesterday's snapshot per make, status and store."""
    return (
        orders_daily.filter(
            (F.col("update_date") == F.lit(as_of - timedelta(days=1))) & ci_not_in(F.col("status"), ["ignore"])
        )
        .groupBy("make", "status", "update_date", "store_id")
        .agg(F.count("order_number").alias("orders"))
    )
