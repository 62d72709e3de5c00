"""Organisation map, leads, acquisitions, spend by distance and speed to market."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import classify as C
from ..functions import dates as D
from ..functions.mappings import STORE_NAME_SHORTS, VOI_GROUPS
from ..functions.text import replace_all
from ..operators.lookup import attach_coordinates, zero_unless_marked
from ..operators.matching import org_hierarchy, split_credit
from ..operators.measures import any_nonzero, distinct_states, duration_components, merge_distinct
from ..operators.predicates import ci_equal, ci_in
from ..operators.stacking import stack_facts, union_distinct


def org_map(entities: DataFrame, manufacturers: DataFrame, more_shorts: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """Stores with market, region, brand groups and a short display name."""
    dominant = F.col("dominant_brand")
    other = F.lit("Other Entity")
    name = F.col("manufacturer_name")
    return org_hierarchy(entities, manufacturers).select(
        F.left("store_id", F.lit(4)).alias("store_id"),
        F.col("entity_name").alias("store_name"), "region_name", "market_name",
        F.coalesce(F.col("segment"), other).alias("segment"),
        F.coalesce(dominant, other).alias("brand_group"),
        F.when(dominant.isNull(), other)
        .when(name == "Acura", "Other Imports")
        .when(dominant == "Other Luxury", name)
        .otherwise(dominant)
        .alias("brand_group_2"),
        F.when(dominant.isin("Chrysler", "Ford", "GM"), dominant).otherwise(name).alias("brand"),
        F.col("market_code").alias("market_id"), F.col("region_code").alias("region_id"),
        "manufacturer_group", "city", "state",
        replace_all(F.col("entity_name"), [*more_shorts, *STORE_NAME_SHORTS]).alias("store_name_short"),
        F.lit("NA").alias("geo_area"),
    )


def enrich_leads(fact: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Leads with their store, market, region, manufacturer, provider and sub-provider; a lead
    without a match keeps NULLs.  Dimension keys are unique, so rows neither vanish nor multiply."""
    return (
        fact.join(dims["store"], "store_eid", "left")
        .join(dims["market"], "market_eid", "left")
        .join(dims["region"], "region_eid", "left")
        .join(dims["manufacturer"], "manufacturer_key", "left")
        .join(dims["provider"], "provider_key", "left")
        .join(dims["subprovider"], "subprovider_key", "left")
    )


def associate_credit(leads: DataFrame, start: date, end: date, markets: Sequence[str]) -> DataFrame:
    """Purchases per month, region and associate; a pair shares its purchase half and half.

    ``leads`` is enriched.  Purchases of a pair that carry no program id have no partner row
    to be matched with and are left out, as in the source report.
    """
    rows = leads.filter(
        F.col("activity_date").between(F.lit(start), F.lit(end)) & ci_in(F.col("market_name"), markets)
        & (F.col("associate_2").isNull() | F.col("program_id").isNotNull())
    )
    keys = [F.year("activity_date").alias("year"), F.month("activity_date").alias("month"), "region_name",
            "associate_1", "associate_2"]
    summed = rows.groupBy(*keys).agg(F.sum("purchase_count").alias("purchases"))
    credited = split_credit(summed, "associate_1", "associate_2", "purchases", "associate")
    return credited.groupBy("year", "month", "region_name", "associate").agg(F.sum("purchases").alias("purchases"))


FUNNEL = [
    "opportunities", "internet_opportunities", "sales", "booked_sales", "contact_made_count",
    "internet_contact_made_count", "minutes_to_contact", "contacted_24h_count", "first_appointment_count",
    "first_visit_count", "first_show_count", "first_menu_count",
]


def funnel(traffic: DataFrame, measures: Sequence[str] = FUNNEL) -> DataFrame:
    return (
        traffic.filter(ci_equal(F.col("department"), "used"))
        .groupBy("month", "market_name", "store", "department")
        .agg(*[F.sum(m).alias(m) for m in measures])
    )


def acquisitions(fact: DataFrame, start: date, end: date) -> DataFrame:
    """Acquired and sold units per month, acquisition group and unit."""
    return (
        fact.filter(F.col("acquisition_date").between(F.lit(start), F.lit(end)))
        .groupBy(
            F.month("acquisition_date").alias("month"),
            C.acquisition_group(F.col("source_grouped")).alias("consolidated_group"), "vin",
        )
        .agg(F.sum("acquisition_count").alias("acquisitions"), F.sum("sold_count").alias("units_sold"))
    )


def lead_measure(measure: Column, group: Column, marker: Column) -> Column:
    """Counts of a trade offer only when the lead led to a purchase somewhere."""
    return zero_unless_marked(measure, F.upper(group).isin(*VOI_GROUPS), marker)


def lead_acquisition_stack(
    leads: DataFrame, acquired: DataFrame, as_of: date, markets: Sequence[str], program: str = "WBYC"
) -> DataFrame:
    """Leads and acquisitions of the last months per unit in one table.

    Both inputs are enriched.  The leads that led to a purchase are found by an aggregate of
    the same rows, reduced to trade offers before it shuffles.
    """
    start = D.add_months(D.month_start(as_of), -5)
    group = F.col("lead_group")
    marked = (
        leads.filter(F.upper(group).isin(*VOI_GROUPS) & (F.col("purchase_count") >= 1))
        .select("lead_id")
        .distinct()
        .withColumn("_bought", F.lit(1))
    )
    recent = leads.filter(F.col("activity_date").between(F.lit(start), F.lit(as_of)) & ci_in(F.col("market_name"), markets))
    counted = lead_measure(F.col("opportunities"), group, F.col("_bought"))
    from_leads = (
        recent.join(marked, "lead_id", "left")
        .groupBy(
            F.year("activity_date").alias("year"), F.month("activity_date").alias("month"), "vin", "region_name",
            "market_name", "store_id", "store_name", "manufacturer_name", "manager", "associate_1", "associate_2",
            C.lead_group(group, F.col("provider_name"), F.col("subprovider_name")).alias("reporting_group"),
            C.lead_subgroup(group, F.col("subprovider_name")).alias("reporting_subgroup"),
        )
        .agg(F.sum(counted).cast("int").alias("lead_count"), F.sum("purchase_count").alias("acquisitions"))
    )
    from_units = (
        acquired.filter(F.col("trx_date").between(F.lit(start), F.lit(as_of)) & ci_in(F.col("market_name"), markets))
        .groupBy(
            F.year("trx_date").alias("year"), F.month("trx_date").alias("month"), "vin", "region_name", "market_name",
            "store_id", "store_name", "manufacturer_name",
        )
        .agg(
            F.sum("acquisition_count").alias("acquisition_count"), F.sum("sold_count").alias("_sold"),
            F.sum(F.when(ci_equal(F.col("source_group_1"), program), F.col("acquisition_count")).otherwise(0)).alias(
                "program_acquisitions"
            ),
        )
        .filter(F.col("acquisition_count") + F.col("_sold") > 0)
        .drop("_sold")
    )
    measures = ["lead_count", "acquisitions", "acquisition_count"]
    stacked = stack_facts([from_leads, from_units], {m: 0 for m in measures})
    return stacked.filter(any_nonzero(*[F.col(m) for m in measures])).select(
        "year", "month", "vin", "reporting_group", *measures,
        C.lead_final(F.col("reporting_group")).alias("reporting_group_final"),
    )


def spend_and_distance(
    leads: DataFrame, stores: DataFrame, zips: DataFrame, spend: DataFrame, start: date, end: date,
    markets: Sequence[str], years: Sequence[int],
) -> DataFrame:
    """Opportunities by distance between customer and store, and the spend they compare with.

    Leads are summed per (store, day, group, postal code) before coordinates are attached.
    ``stores`` carries store_eid, zip and market_name; zip codes are unique.
    """
    summed = (
        leads.filter(F.col("activity_date").between(F.lit(start), F.lit(end)))
        .groupBy("store_eid", "activity_date", "lead_group", "cust_zip_code")
        .agg(F.sum("opportunities").alias("opportunities"), F.sum("purchase_count").alias("purchase_count"))
    )
    placed = attach_coordinates(
        attach_coordinates(summed.join(stores, "store_eid", "left"), zips, "zip", "store"), zips, "cust_zip_code", "cust"
    )
    miles = C.distance_miles(
        F.col("cust_latitude"), F.col("cust_longitude"), F.col("store_latitude"), F.col("store_longitude")
    )
    by_band = (
        placed.groupBy(
            F.year("activity_date").alias("yr"), F.month("activity_date").alias("mnth"), "market_name", "lead_group",
            C.distance_band(miles).alias("distance_band"),
        )
        .agg(F.sum("opportunities").alias("opportunities"), F.sum("purchase_count").alias("purchase_count"))
        .filter(any_nonzero(F.col("opportunities"), F.col("purchase_count")))
        .withColumn("spend", F.lit(0).cast("decimal(29,4)"))
    )
    spent = (
        spend.filter(ci_in(F.col("market_name"), markets) & F.col("yr").isin(*years))
        .groupBy("yr", "mnth", "market_name", "lead_group")
        .agg(F.sum("adv_spend").cast("decimal(29,4)").alias("spend"))
        .filter(F.col("spend") > 0)
        .select(
            "yr", "mnth", "market_name", "lead_group", F.lit(None).cast("string").alias("distance_band"),
            F.lit(0).cast("long").alias("opportunities"), F.lit(0).cast("long").alias("purchase_count"), "spend",
        )
    )
    return union_distinct(by_band, spent)


def speed_bands(
    photos: DataFrame, daily: DataFrame, start: date, end: date, keys: Sequence[str] = ("mth", "store_id", "flag")
) -> DataFrame:
    """Units per month, store and days-to-photo band, for used stock that was on the lot.

    The daily table only decides which units count, so it is a semi join; the distinct count
    is exact.
    """
    units = _photo_units(photos, daily, start, end)
    return units.groupBy(*keys).agg(F.countDistinct("vin").alias("vin_count"))


def _photo_units(photos: DataFrame, daily: DataFrame, start: date, end: date) -> DataFrame:
    on_lot = daily.filter(
        ci_equal(F.col("stock_type"), "used") & (F.col("valid_for_group") == 1) & ci_equal(F.col("status"), "S")
        & (F.upper("image_type") != "STOCKPHOTOS")
    ).select("vin")
    days = C.photo_days(F.col("entry_date"), F.col("photo_date"))
    return (
        photos.filter(F.col("snapshot_date").between(F.lit(start), F.lit(end)) & days.between(0, 30))
        .join(on_lot, "vin", "left_semi")
        .withColumn("flag", C.photo_band(days))
        .withColumn("mth", F.month("snapshot_date"))
    )


def speed_band_states(photos: DataFrame, daily: DataFrame, start: date, end: date) -> DataFrame:
    """As :func:`speed_bands`, but a row per calendar month with a state that merges: store it by ``snapshot_month``."""
    units = _photo_units(photos, daily, start, end).withColumn("snapshot_month", D.month_of(F.col("snapshot_date")))
    return distinct_states(units, ["snapshot_month", "store_id", "flag"], "vin")


def speed_bands_over(states: DataFrame, first: date, last: date, keys: Sequence[str] = ("store_id", "flag")) -> DataFrame:
    """Estimated units per store and band, or per fewer ``keys``, over the months ``first`` to ``last`` of stored states."""
    return merge_distinct(states.filter(F.col("snapshot_month").between(F.lit(first), F.lit(last))), keys, "vin_count")


PHOTO_BANDS = {"under_5": (None, 5), "under_10": (5, 10), "above_10": (10, 30), "all": (None, 30)}


def speed_components(photos: DataFrame, stores: DataFrame, start: date, end: date) -> DataFrame:
    """Days and records per band, to be averaged later.  The first day of the window stays a
    row of its month but adds nothing."""
    days = C.photo_days(F.col("entry_date"), F.col("photo_date"))
    counted = (F.col("snapshot_date") > F.lit(start)) & (F.col("entry_date") <= F.col("photo_date"))
    return (
        photos.filter(F.col("snapshot_date").between(F.lit(start), F.lit(end)))
        .join(stores.select("store_id"), "store_id")
        .groupBy(D.month_of(F.col("snapshot_date")).alias("snapshot_month"), "store_id")
        .agg(*duration_components(days, counted, PHOTO_BANDS))
    )
