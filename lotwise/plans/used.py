"""Used vehicles: inventory, sales by unit, price changes, strategy stack, first target price."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import classify as C
from ..functions import dates as D
from ..operators.measures import any_nonzero, recon_cost, sum_if_max
from ..operators.predicates import ci_equal, ci_not_in
from ..operators.stacking import stack_facts
from ..operators.windows import earliest_per, latest_per, prefer_source, price_changes, price_runs


def _max_abs(name: str) -> Column:
    return F.max(F.abs(F.col(name)))


def source_history(daily: DataFrame, as_of: date, days: int = 50) -> DataFrame:
    """Newest source label per unit over the last days."""
    recent = daily.filter(
        (F.col("department") == "320") & D.last_days(F.col("snapshot_date"), days, as_of)
        & (F.to_date("snapshot_date") <= F.lit(as_of)) & (F.upper("status") != "G")
    ).select(
        "vin", "snapshot_date", "store_id",
        C.source_group(F.col("original_source_code"), F.col("source_code")).alias("source"),
    )
    return latest_per(recent, ["vin"], ["snapshot_date", "store_id", "source"]).select("vin", "source")


def used_inventory(
    month_end: DataFrame, live: DataFrame, daily: DataFrame, as_of: date, month: date, excluded_region: str,
    excluded_markets: Sequence[str], group_prefix: str, week: str = "Week 1",
) -> DataFrame:
    """Month-end units plus live ones, one row per unit with the month-end row preferred.

    Units without a number cannot be matched and all stay.  The source falls back from the
    original code to the current code to the newest label of the last fifty days.
    """
    history = source_history(daily, as_of).select("vin", F.col("source").alias("history_source"))
    days = F.col("days_in_inventory_group")
    web, cost, target = F.col("price_tier_93"), F.col("balance"), F.col("target_price")
    closed = month_end.filter(
        (F.col("department") == "320") & (F.col("accounting_month") == F.lit(month))
        & (F.upper("region_name") != excluded_region.upper()) & ci_not_in(F.col("market_name"), excluded_markets)
        & ci_equal(F.col("status"), "S")
    ).join(history, "vin", "left")
    by_unit = [
        "vin", "store_name", "region_name", "market_name", "store_id", "year", "make", "model",
        C.age_bucket(days).alias("age_bucket"),
        C.price_bucket_inclusive(web, cost).alias("price_bucket"),
        C.valid_price(web, cost, target).alias("valid_price_bucket"),
        C.source_group(F.col("original_source_code"), F.col("source_type"), F.col("history_source")).alias(
            "inventory_source"
        ),
    ]
    first = (
        closed.groupBy(*by_unit)
        .agg(
            F.sum("inventory_count").alias("inventory_count"), F.sum("balance").alias("balance"),
            F.sum("target_price").alias("target_price"),
        )
        .filter(F.col("inventory_count") == 1)
        .select(
            "vin", "store_name", "inventory_source", "inventory_count", "price_bucket", "valid_price_bucket",
            "age_bucket", "balance", "target_price",
            F.lit(1).alias("type_no"), F.lit("MonthEnd").alias("type"),
        )
    )
    second = (
        live.filter(ci_equal(F.col("stock_type"), "used") & (F.col("valid_for_group") == 1))
        .join(history, "vin", "left")
        .select(
            "vin", "store_name",
            C.source_group(F.col("original_source_code"), F.col("source_code"), F.col("history_source")).alias(
                "inventory_source"
            ),
            F.lit(1).cast("long").alias("inventory_count"),
            C.price_bucket_open(web).alias("price_bucket"),
            C.valid_price(web, cost, target).alias("valid_price_bucket"),
            C.age_bucket(days).alias("age_bucket"),
            "balance", "target_price", F.lit(2).alias("type_no"), F.lit("Live").alias("type"),
        )
    )
    both = stack_facts([first, second])
    order = ["type_no", "store_name", "age_bucket", "price_bucket", "inventory_source", "valid_price_bucket",
             "balance", "target_price", "type", "inventory_count"]
    kept = prefer_source(both, "vin", order)
    week_no = int(week.split()[-1]) if week.startswith("Week") else 0
    return (
        kept.withColumn("status", F.lit("S Status"))
        .withColumn("accounting_month", F.lit(month))
        .withColumn("week", F.lit(week))
        .withColumn("week_flag", F.lit(week_no))
        .withColumn("source_side", C.source_side(F.col("inventory_source")))
        .withColumn("inventory_source", C.source_label(F.col("inventory_source")))
        .withColumn("franchise_type", C.franchise_type(F.col("store_name"), group_prefix))
        .withColumn("collapsed_age_bucket", C.collapse_age(F.col("age_bucket")))
        .withColumn("as_of", F.lit(as_of))
    )


SALE_SUMS = {
    "sold_count": "sold_count", "interco_count": "interco_count", "auction_count": "wholesale_count",
    "fi_count": "cfs_count", "front_gross": "base_gross", "interco_gross": "interco_gross",
    "auction_gross": "wholesale_gross", "front_revenue": "retail_revenue", "interco_revenue": "interco_revenue",
    "auction_revenue": "wholesale_revenue", "fi_gross": "cfs_gross", "ovi": "ovi_gross",
}


def used_sales(sales: DataFrame, month: date, regions: Sequence[str]) -> DataFrame:
    """Used sales of a month per unit, with prices only where they compare with the target."""
    rows = sales.filter(
        ci_equal(F.col("department"), "used") & (F.col("accounting_month") == F.lit(month))
        & F.col("region_name").isin(*regions) & ci_equal(F.col("record_source"), "accounting")
    )
    keys = ["accounting_month", "make", "market_name", "model", "store_id", "store_name", "vin"]
    units = rows.groupBy(*keys, C.sale_source(F.col("source_name"), F.col("source_type")).alias("source")).agg(
        *[F.sum(src).alias(out) for src, out in SALE_SUMS.items()],
        _max_abs("vehicle_age_group").alias("_age_group"), _max_abs("vehicle_age").alias("_age"),
        _max_abs("cash_price").alias("_price"), _max_abs("interco_revenue").alias("_interco"),
        _max_abs("target_price").alias("_target"), F.sum("front_cos").alias("_cost"),
        _max_abs("sold_count").alias("_sold"),
    )
    moved = units.filter(
        any_nonzero(
            *[F.col(c) for c in ("sold_count", "base_gross", "interco_gross", "ovi_gross", "cfs_gross",
                                 "wholesale_count", "interco_count", "wholesale_gross")]
        )
    )
    ok = C.price_gate(F.col("sold_count"), F.col("_price"), F.col("_target"), F.col("_cost"))
    return moved.withColumn("_ok", ok).select(
        *keys[:1], D.quarter_label(F.col("accounting_month")).alias("quarter"), *keys[1:], *SALE_SUMS.values(), "source",
        (F.col("_age_group") * F.col("sold_count")).alias("days_to_sell"),
        C.age_band_short(F.col("_age_group")).alias("group_age"),
        C.age_band_short(F.col("_age")).alias("store_age"),
        C.price_band(F.col("_price"), F.col("_interco")).alias("price_band"),
        C.gated(F.col("_ok"), F.col("_price")).alias("cash_price"),
        C.gated(F.col("_ok"), F.col("_cost")).alias("cost"),
        C.gated(F.col("_ok"), F.col("_target")).alias("target_price"),
        C.gated(F.col("_ok"), F.col("_sold")).alias("sold_count_adj"),
    )


def used_price_changes(daily: DataFrame, as_of: date, tie: Sequence[str], days: int = 65, show: int = 14) -> DataFrame:
    """Price changes of the last two weeks of units that changed price within the window."""
    rows = daily.filter(
        D.last_days(F.col("snapshot_date"), days, as_of) & ci_equal(F.col("status"), "S")
        & (F.col("department") == "320") & F.col("internet_price").isNotNull()
    ).withColumn("snapshot_date", F.to_date("snapshot_date"))
    runs = price_runs(rows, "vin", "store_name", "internet_price", "snapshot_date", tie)
    changes = price_changes(runs, "vin", "store_name").filter(D.last_days(F.col("snapshot_date"), show, as_of))
    price, cost = F.col("internet_price"), F.col("balance")
    target, good = F.coalesce("target_price", F.lit(0)), F.col("good_price")
    return changes.select(
        "snapshot_date", "market_name", "store_name", "status", "vin", "year", "make", "model", "trim", "mileage",
        C.source_group(F.col("original_source_code"), F.col("source_code")).alias("original_source"),
        F.col("days_in_inventory_group").alias("group_age"), F.col("days_in_inventory").alias("store_days"),
        price.alias("price"), cost.alias("cost"),
        C.if_benchmarked(price, target, good).alias("price_adj"),
        C.if_benchmarked(cost, target, good).alias("cost_adj"),
        C.if_benchmarked(target, target, good).alias("target"),
        C.if_benchmarked(good, target, good).alias("benchmark_price"),
        C.price_rank(price, F.col("great_price"), good, F.col("fair_price"), F.col("poor_price")).alias("price_rank"),
        "days_at_price", F.col("price_change_flag").alias("price_change_count"), F.lit(1).alias("count"),
    )


def used_inventory_buckets(inventory: DataFrame, since: date, excluded_region: str, excluded_markets: Sequence[str]) -> DataFrame:
    days = F.col("days_in_inventory_group")
    return (
        inventory.filter(
            (F.col("accounting_month") >= F.lit(since)) & (F.upper("region_name") != excluded_region.upper())
            & ci_not_in(F.col("market_name"), excluded_markets)
            & (F.col("balance") > 0) & (F.col("inventory_count") > 0) & (F.col("department") == "320")
            & ci_equal(F.col("status"), "S")
        )
        .groupBy(
            "accounting_month",
            C.threshold_bucket(days, 45).alias("bucket_45"),
            C.threshold_bucket(days, 120).alias("bucket_120"),
            C.price_bucket_positive(F.col("price_tier_93")).alias("price_bucket"),
        )
        .agg(F.sum("inventory_count").alias("inv_count"))
        .filter(F.col("inv_count") != 0)
    )


STRATEGY_MEASURES = [
    "sold_count", "base_gross", "interco_gross", "cfs_gross", "ovi_gross", "cash_price", "target_price",
    "recon_cost", "inv_count", "inv_price", "inv_balance", "inv_target_price", "inv_over_45", "inv_over_120",
]


def strategy_stack(
    inventory: DataFrame, sales: DataFrame, start: date, end: date, region: str, excluded_markets: Sequence[str],
    group_prefix: str,
) -> DataFrame:
    """Used sales and inventory per month, source, price band and age band.

    Both facts are reduced to one row per unit before bands are assigned and the stack is summed.
    """
    source = C.source_group(F.col("original_source_code"), F.col("source_type")).alias("source")
    keys = [F.year("accounting_month").alias("year"), F.month("accounting_month").alias("month"),
            "market_name", C.franchise_type(F.col("store_name"), group_prefix).alias("market_type"),
            "store_id", "store_name", "vin", source]
    months = F.col("accounting_month").between(F.lit(start), F.lit(end)) & ci_equal(F.col("region_name"), region)
    sold = (
        sales.filter(months & ci_equal(F.col("department"), "used") & ci_equal(F.col("record_source"), "accounting"))
        .groupBy(*keys)
        .agg(
            F.sum("sold_count").alias("sold_count"), F.sum("front_gross").alias("base_gross"),
            F.sum("interco_gross").alias("interco_gross"), F.sum("fi_gross").alias("cfs_gross"),
            F.sum("ovi").alias("ovi_gross"),
            recon_cost(F.col("sold_count"), F.col("recon_cost"), F.col("non_ro_amount")).alias("recon_cost"),
            _max_abs("vehicle_age_group").alias("_age"), _max_abs("front_revenue").alias("_price"),
            _max_abs("interco_revenue").alias("_interco"), _max_abs("target_price").alias("_target"),
        )
        .filter(any_nonzero(*[F.col(c) for c in STRATEGY_MEASURES[:5]]))
    )
    sold_ok = C.price_gate(F.col("sold_count"), F.col("_price"), F.col("_target"))
    sold = sold.select(
        "year", "month", "source", C.age_band(F.col("_age")).alias("age_bucket"),
        C.price_band(F.col("_price"), F.col("_interco")).alias("price_band"),
        *STRATEGY_MEASURES[:5], "recon_cost",
        C.gated(sold_ok, F.col("_price")).alias("cash_price"), C.gated(sold_ok, F.col("_target")).alias("target_price"),
    )
    stock = (
        inventory.filter(
            months & (F.col("department") == "320") & ci_equal(F.col("status"), "S")
            & ci_not_in(F.col("market_name"), excluded_markets)
        )
        .groupBy(*keys)
        .agg(
            F.sum("inventory_count").alias("inv_count"), _max_abs("days_in_inventory_group").alias("_age"),
            _max_abs("internet_price").alias("_price"), _max_abs("price_tier_93").alias("_web"),
            _max_abs("balance").alias("_balance"), _max_abs("target_price").alias("_target"),
            sum_if_max(F.col("days_in_inventory_group"), 45, F.col("inventory_count")).alias("inv_over_45"),
            sum_if_max(F.col("days_in_inventory_group"), 120, F.col("inventory_count")).alias("inv_over_120"),
        )
        .filter(F.col("inv_count") != 0)
    )
    stock_ok = C.price_gate(F.col("inv_count"), F.col("_price"), F.col("_target"), F.col("_balance"))
    stock = stock.select(
        "year", "month", "source", C.age_band(F.col("_age")).alias("age_bucket"),
        C.price_band(F.col("_price"), F.col("_web"), F.col("_balance")).alias("price_band"),
        "inv_count", "inv_over_45", "inv_over_120",
        C.gated(stock_ok, F.col("_price")).alias("inv_price"), C.gated(stock_ok, F.col("_balance")).alias("inv_balance"),
        C.gated(stock_ok, F.col("_target")).alias("inv_target_price"),
    )
    stacked = stack_facts([sold, stock], {m: 0 for m in STRATEGY_MEASURES})
    return (
        stacked.groupBy("year", "month", "source", "price_band", "age_bucket")
        .agg(*[F.sum(m).alias(m) for m in STRATEGY_MEASURES])
        .withColumn("source_group", C.source_side_short(F.col("source")))
    )


def sold_and_trades(sales: DataFrame, start: date, end: date, region: str) -> DataFrame:
    """Units sold and units sold with a trade-in, per month."""
    rows = sales.filter(
        F.col("accounting_month").between(F.lit(start), F.lit(end)) & ci_equal(F.col("region_name"), region)
        & ci_equal(F.col("record_source"), "accounting")
    )
    per_trade = (
        rows.groupBy(F.month("accounting_month").alias("month"), F.year("accounting_month").alias("year"), "trade_vin")
        .agg(F.sum("sold_count").alias("_sold"))
        .filter(F.col("_sold") != 0)
    )
    return per_trade.groupBy("month", "year").agg(
        F.sum("_sold").alias("vehicle_sold"),
        F.sum(F.when(F.col("trade_vin").isNotNull(), F.col("_sold")).otherwise(0)).alias("trades"),
    )


def wholesale(sales: DataFrame, start: date, end: date, region: str) -> DataFrame:
    return (
        sales.filter(
            ci_equal(F.col("department"), "used") & F.col("accounting_month").between(F.lit(start), F.lit(end))
            & ci_equal(F.col("region_name"), region)
        )
        .groupBy(F.month("accounting_month").alias("month"), F.year("accounting_month").alias("year"))
        .agg(F.sum("auction_count").alias("wholesale_sold"))
        .filter(F.col("wholesale_sold") != 0)
    )


def first_target_price(daily: DataFrame, start: date, end: date, tie: Sequence[str]) -> DataFrame:
    """First usable target price of each unit in a store."""
    usable = daily.filter(
        (F.col("department") == "320") & D.between_days(F.col("snapshot_date"), start, end)
        & (F.upper("status") != "G") & (F.col("target_price") != 0) & (F.col("balance") >= F.col("original_acv"))
    ).select("vin", "store_id", "snapshot_date", *tie, "target_price", "original_acv", "balance")
    first = earliest_per(usable, ["vin", "store_id"], ["snapshot_date", *tie])
    return first.select("vin", "target_price", "original_acv", "balance").distinct()
