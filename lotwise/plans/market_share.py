"""Market-share cubes and the industry file."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import classify as C
from ..operators.lookup import lookup, override_blank, restrict_to_allowed
from ..operators.measures import per_unit, round_half_even, share_of_total, ytd_rows, ytd_sums
from ..operators.predicates import drop_overlap
from ..operators.stacking import stack_facts
from ..operators.windows import flag_latest
from ..session import written

ENTITY = ["store_num", "selling_dealer", "group_market", "brand_group", "segment", "make_market", "market_name"]


def prepare_sales(current: DataFrame, history: DataFrame, dims: Mapping[str, DataFrame], as_of: date) -> DataFrame:
    """Current and historical registrations without overlap, limited to the allowed make and
    market pairs, with group market, brand, overrides and segment.

    ``dims``: allowed (market_name, make), market (market_name, group_market), brand (make,
    brand_group), override (site_code, own_store_override, selling_dealer_override); keys are
    unique.  Sales are summed to the grain of the cube before the lookups, so that the joins
    handle sums and not registrations.  The lists that may be derived from facts (allowed, brand) are stored:
    their files have their true size, so no sales are shuffled to meet them.
    """
    both = stack_facts([drop_overlap(current, as_of), history])
    allowed = restrict_to_allowed(both, written(dims["allowed"], "allowed-pairs"), ["market_name", "make"])
    grain = ["market_name", "make", "site_code", "own_store", "selling_dealer", "sale_year", "sale_month"]
    summed = written(allowed.groupBy(*grain).agg(F.sum("mtd_sales").alias("mtd_sales")), "grain-sums")
    named = lookup(summed, dims["market"], ["market_name"], ["group_market"])
    named = lookup(named, written(dims["brand"], "brands"), ["make"], ["brand_group"])
    named = override_blank(
        named, dims["override"], ["site_code"],
        {"own_store": "own_store_override", "selling_dealer": "selling_dealer_override"},
    )
    return named.withColumn("segment", C.brand_segment(F.col("brand_group"))).withColumn(
        "make_market", F.concat("make", "market_name")
    )


def monthly_cube(sales: DataFrame) -> DataFrame:
    """Monthly sales per store or competitor with their share of make and market.  Own stores
    keep an empty store as their own; the competition's store label is blank."""
    store = C.store_or_competition(F.col("own_store"), blank_is_competition=False)
    monthly = (
        sales.withColumn("store_num", store)
        .groupBy(*ENTITY, "sale_month", "sale_year")
        .agg(F.sum("mtd_sales").alias("mtd_sales"))
    )
    shared = share_of_total(
        monthly, ["make_market", "sale_month", "sale_year"], "mtd_sales", "make_market_sales", "share_pct", stored=True
    )
    rival, own = C.split_measure(F.col("store_num"), F.col("mtd_sales"))
    return shared.select(
        F.when(F.col("store_num") == "Competition", "").otherwise(F.col("store_num")).alias("store_num"),
        "selling_dealer", "brand_group", "group_market", "market_name", "segment", "share_pct",
        F.col("sale_month").alias("time"), F.col("sale_year").alias("year"), "make_market_sales", "mtd_sales",
        rival.alias("comp_sales"), own.alias("own_sales"),
    )


def ytd_cube(sales: DataFrame, as_of: date) -> DataFrame:
    """Year-to-date sales and shares up to each month of ``as_of``'s year, for every year."""
    store = C.store_or_competition(F.col("own_store"), blank_is_competition=True)
    named = sales.withColumn("store_num", store)
    # Stored, as the totals are summed from the entities' sums and joined to them; the totals' file has their true size.
    sums = written(ytd_sums(named, [*ENTITY, "sale_year"], "sale_month", "mtd_sales", as_of), "ytd-sums")
    group = ["make_market", "sale_year"]
    totals = sums.groupBy(*group).agg(
        F.array(*[F.sum(F.element_at("_sums", m)) for m in range(1, as_of.month + 1)]).alias("make_market_sales")
    )
    totals = written(totals, "ytd-totals").select(*[F.col(k).alias(f"_{k}") for k in group], "make_market_sales")
    same = F.col("make_market").eqNullSafe(F.col("_make_market")) & F.col("sale_year").eqNullSafe(F.col("_sale_year"))
    met = sums.filter((F.col("store_num") != "") & F.col("store_num").isNotNull()).join(totals, same)
    ytd = ytd_rows(met, [*ENTITY, "sale_year"], "ytd_sales", "time", "make_market_sales")
    shared = ytd.withColumn("share_pct", round_half_even(per_unit(F.col("ytd_sales"), F.col("make_market_sales")), 3))
    rival, own = C.split_measure(F.col("store_num"), F.col("ytd_sales"))
    return shared.select(
        "store_num", "selling_dealer", "brand_group", "group_market", "market_name", "segment", "share_pct", "time",
        F.col("sale_year").alias("year"), "make_market_sales", "ytd_sales",
        rival.alias("comp_sales"), own.alias("own_sales"),
    )


def tag_industry(industry: DataFrame, as_of: date) -> DataFrame:
    """Industry sales with brand, segment, newest-file and current-month flags."""
    current = F.col("sale_year").isin(as_of.year, as_of.year - 1) & (F.col("sale_month") == as_of.month)
    tagged = (
        industry.withColumn("brand", C.industry_brand(F.col("make")))
        .withColumn("segment", C.brand_segment(F.col("brand")))
        .withColumn("is_current_month", F.coalesce(current.cast("int"), F.lit(0)))
    )
    return flag_latest(tagged, "file_date", "is_max_date")
