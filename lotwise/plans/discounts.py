"""Discount tracking of new inventory on two weekly snapshots."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.mappings import ECOM_ONLY_MAKES
from ..functions.text import composite_key
from ..operators.lookup import lookup
from ..operators.measures import row_mean
from ..operators.predicates import ci_equal, eligible_units, on_days

EXCLUDED_MARKETS = ("market 97", "market 98")
KEYS = [
    "snapshot_date", "region_name", "market_name", "store_name", "store_id", "stock_type", "vin", "year", "make",
    "model", "trim", "style_id", "style_name", "days_in_inventory", "price_tier_93", "price_tier_95", "msrp",
    "invoice_price", "balance", "vin_priced", "status", "ex_service", "loaner",
]


def discount_columns(website: Column, ecom: Column, msrp: Column, make: Column, days: Column) -> dict[str, Column]:
    """Flag, discounts, average and opportunity.  Zero e-commerce price means no discount; a
    missing price never makes a unit discounted."""
    lower = F.coalesce(website < msrp, F.lit(False)) | F.coalesce(ecom < msrp, F.lit(False))
    yes = lower & F.coalesce(ecom != 0, F.lit(True))
    web_off = F.when(yes, msrp - website).otherwise(0)
    ecom_off = F.when(yes, msrp - ecom).otherwise(0)
    average = F.when(make.isin(*ECOM_ONLY_MAKES), ecom_off.cast("double")).otherwise(row_mean(web_off, ecom_off))
    return {
        "discounted": F.when(yes, "Yes").otherwise("No"),
        "website_discount": web_off,
        "ecom_discount": ecom_off,
        "avg_discount": average,
        "discount_opportunity": F.when(~yes & (days > 45), "Opportunity").otherwise("N/A"),
        "over_45_days": F.when(days > 45, "Yes").otherwise("No"),
    }


def unit_key() -> Column:
    parts = [F.col("make"), F.col("model"), F.col("trim"), F.coalesce("style_id", F.lit(0)), F.col("style_name")]
    return composite_key(*parts)


def discount_tracking(daily: DataFrame, approved: DataFrame, as_of: date, excluded_region: str, min_year: int = 2021) -> DataFrame:
    """Units on yesterday's snapshot and the one a week earlier, with discounts and the
    over-list approval.  ``approved``: key, approval; keys are unique."""
    current, previous = as_of - timedelta(days=1), as_of - timedelta(days=8)
    rows = daily.filter(on_days(F.col("snapshot_date"), [previous, current]) & ci_equal(F.col("stock_type"), "new"))
    units = eligible_units(rows, EXCLUDED_MARKETS, excluded_region, min_year).select(*KEYS).distinct()
    computed = units.withColumns(
        discount_columns(
            F.col("price_tier_93"), F.col("price_tier_95"), F.col("msrp"), F.col("make"), F.col("days_in_inventory")
        )
    )
    label = F.when(F.to_date("snapshot_date") == F.lit(current), "Current").otherwise("Previous")
    keyed = computed.withColumn("snapshot", label).withColumn("key", unit_key())
    found = lookup(keyed, approved, ["key"], {"approval": "approved_over_list"}, "Not Approved")
    return found.select("key", *[c for c in found.columns if c != "key"])
