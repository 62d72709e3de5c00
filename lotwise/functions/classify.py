"""Classification rules as column expressions: no joins, no UDFs, inside codegen."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import mappings as M


def lookup_map(groups: Mapping[str, Iterable[str]]) -> Column:
    """``{label: members}`` as a literal map column member -> label."""
    pairs = [F.lit(x) for label, members in groups.items() for member in members for x in (member, label)]
    return F.create_map(*pairs)


def grouped(key: Column, groups: Mapping[str, Iterable[str]], default: Column | None = None) -> Column:
    found = F.try_element_at(lookup_map(groups), key)
    return found if default is None else F.coalesce(found, default)


# --- make, brand, segment -----------------------------------------------------


def brand_group(make: Column, variant: str) -> Column:
    """Brand group of a make; comparison ignores case, as the source database does."""
    default = M.BRAND_GROUP_DEFAULT.get(variant)
    return grouped(F.upper(make), M.BRAND_GROUPS[variant], make if default is None else F.lit(default))


def segment(make: Column, variant: str) -> Column:
    default = M.SEGMENT_DEFAULT.get(variant)
    return grouped(F.upper(make), M.SEGMENTS[variant], None if default is None else F.lit(default))


def brand_segment(brand: Column) -> Column:
    """Segment of a market-share brand; case-sensitive."""
    return grouped(brand, M.BRAND_SEGMENTS, F.lit("Other"))


def industry_brand(make_code: Column) -> Column:
    return map_values(make_code, M.INDUSTRY_BRANDS, "Unknown")


def map_values(key: Column, mapping: Mapping[str, str], default: str | None = None) -> Column:
    """Dictionary lookup with a default; a dict keeps the last value of a repeated key."""
    found = F.try_element_at(F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair]), key)
    return found if default is None else F.coalesce(found, F.lit(default))


# --- acquisition source -------------------------------------------------------


def source_code_group(code: Column) -> Column:
    return grouped(F.upper(code), M.SOURCE_GROUPS)


def source_group(original: Column, current: Column, history: Column | None = None) -> Column:
    """First code that maps: the original one, the current one, then the label from history."""
    candidates = [source_code_group(original), source_code_group(current)]
    if history is not None:
        candidates.append(history)
    return F.coalesce(*candidates, F.lit("Other"))


def source_side(group: Column) -> Column:
    return F.when(F.upper(group).isin(*M.INTERNAL_SOURCES), "Total: Int. Sourced").otherwise("Total: Ext. Sourced")


def source_side_short(group: Column) -> Column:
    return F.when(F.upper(group).isin("AUCTION/RENTAL", "OTHER"), "External").otherwise("Internal")


def source_label(group: Column) -> Column:
    return grouped(group, M.SOURCE_LABELS, group)


def sale_source(source_name: Column, source_type: Column) -> Column:
    code = F.when(F.left(source_name, F.lit(len(M.DIRECT_PREFIX))) == M.DIRECT_PREFIX, M.DIRECT_SOURCE).otherwise(
        source_type
    )
    return grouped(F.upper(code), M.SALE_SOURCES, F.lit("Other"))


def acquisition_group(source: Column) -> Column:
    return grouped(F.upper(source), M.ACQUISITION_GROUPS, F.lit("NONE"))


# --- age ----------------------------------------------------------------------


def age_bucket(days: Column) -> Column:
    edges = [
        (16, "01: 0-15"), (31, "02: 16-30"), (46, "03: 31-45"), (61, "04: 46-60"), (91, "05: 61-90"),
        (121, "06: 91-120"),
    ]
    bucket = F.when(days.isNull(), "N/A")
    for upper, label in edges:
        bucket = bucket.when(days < upper, label)
    return bucket.otherwise("07: Over 120")


def collapse_age(bucket: Column) -> Column:
    return (
        F.when(bucket.startswith("N/A"), "01: 0-15")
        .when(bucket.startswith("06:") | bucket.startswith("07:"), "06: >90")
        .otherwise(bucket)
    )


def threshold_bucket(days: Column, limit: int) -> Column:
    return (
        F.when(days.isNull(), "N/A")
        .when(days < limit, f"Under {limit} Days")
        .otherwise(f"Over/At {limit} Days")
    )


def age_band(days: Column) -> Column:
    return (
        F.when(days.between(0, 45), "0-45")
        .when(days.between(45, 120), "46-120")
        .when(days.between(120, 1200), "120+")
        .otherwise("Adjustments")
    )


def age_band_short(days: Column) -> Column:
    return F.when(days.between(0, 45), "0-45").otherwise(">45")


# --- price --------------------------------------------------------------------

_BUCKETS = ("1:0-20,000", "2:20,001 - 40,000", "3:Over 40,001")


def _inclusive(chain, value: Column, first: float, labels: tuple[str, str, str]):
    for low, high, label in zip((first, 20000, 40000), (20000, 40000, 1000000), labels):
        chain = chain.when(value.between(low, high), label)
    return chain


def price_bucket_inclusive(price: Column, cost: Column) -> Column:
    """Bands with shared edges (the lower one wins), falling back to the cost."""
    chain = _inclusive(F, price, 0.01, _BUCKETS)
    return _inclusive(chain, cost, 0.01, _BUCKETS).otherwise("N/A")


def price_bucket_open(price: Column) -> Column:
    """Half-open bands without a fallback or an upper limit."""
    return (
        F.when(price.isNull(), "N/A")
        .when(price < 20001, _BUCKETS[0])
        .when(price < 40001, _BUCKETS[1])
        .otherwise(_BUCKETS[2])
    )


def price_bucket_positive(price: Column) -> Column:
    return F.when(price < 1, "N/A").otherwise(price_bucket_open(price))


def price_band(*measures: Column) -> Column:
    """First measure, in the order given, that falls into a band."""
    chain = F
    for measure in measures:
        chain = _inclusive(chain, measure, 1, ("$0-$20k", "$20-$40k", "$40k+"))
    return chain.otherwise("Adjustments")


def valid_price(*prices: Column) -> Column:
    bad = reduce(lambda a, b: a | b, [p.isNull() | (p < 1) for p in prices])
    return F.when(bad, "N/A").otherwise("Valid")


def price_gate(units: Column, price: Column, target: Column, *also_present: Column) -> Column:
    """True for a unit whose price can be compared with its target price."""
    present = [price, target, *also_present]
    ok = F.coalesce(units != 0, F.lit(True)) & (price <= target + 10000) & (target >= 1000) & (price >= 1000) & (price + 10000 >= target)
    for value in present:
        ok = ok & value.isNotNull() & (value != 0)
    return F.coalesce(ok, F.lit(False))


def gated(ok: Column, measure: Column) -> Column:
    """The measure where the gate is open and 0 elsewhere; a NULL measure stays NULL."""
    return F.when(ok, measure).otherwise(F.lit(0).cast("int"))


def if_benchmarked(measure: Column, target: Column, benchmark: Column) -> Column:
    return F.when((target > 0) & (benchmark > 0), measure).otherwise(F.lit(0).cast("int"))


def price_rank(price: Column, great: Column, good: Column, fair: Column, poor: Column) -> Column:
    return (
        F.when(price >= poor + F.lit(0.01), "CG_Overpriced")
        .when(price.between(fair + F.lit(0.01), poor), "CG_High")
        .when(price.between(good + F.lit(0.01), fair), "CG_Fair")
        .when(price.between(great + F.lit(0.01), good), "CG_Good")
        .when(price <= great, "CG_Great")
        .otherwise("CG_Unk")
    )


def is_discounted(website: Column, ecom: Column, msrp: Column) -> Column:
    return F.coalesce(website < msrp, F.lit(False)) | F.coalesce(ecom < msrp, F.lit(False))


def franchise_type(store_name: Column, prefix: str) -> Column:
    return F.when(store_name.startswith(prefix), "Non-Franchise").otherwise("Franchise")


# --- plan, leads, distance, photos, fuel --------------------------------------


def plan_measure(code: Column) -> Column:
    return grouped(F.upper(code), M.PLAN_CODES, F.lit("ERROR"))


def lead_group(group: Column, provider: Column, subprovider: Column | None = None) -> Column:
    """Lead group; with a sub-provider the partner leads are told apart as well."""
    upper = F.upper(group)
    rule = F.when(upper.isin(*M.VOI_GROUPS), M.NON_PROGRAM_LEAD).when(
        upper.isin(*M.SELL_GROUPS) & (F.upper(provider) != M.SHOWROOM_PROVIDER), M.SELL_ONLY_LEAD
    )
    if subprovider is not None:
        partner = (F.upper(subprovider) == M.PARTNER_SUBPROVIDER.upper()) & (
            F.upper(provider) == M.PARTNER_PROVIDER.upper()
        )
        rule = rule.when(partner, M.PARTNER_LEAD)
    return rule.when(upper == "UNKNOWN", M.NON_PROGRAM_LEAD).otherwise(group)


def lead_subgroup(group: Column, subprovider: Column) -> Column:
    return F.when(F.upper(group).isin(*M.SELL_GROUPS), map_values(subprovider, M.SUBPROVIDER_LABELS))


def lead_final(group: Column) -> Column:
    return F.when(F.upper(group).isin(M.SELL_ONLY_LEAD, M.CASH_OFFER), group).otherwise(M.OTHER_LEAD)


def distance_miles(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Planar miles with two decimals, -1 when a coordinate is missing."""
    squared = F.pow((lat1 - lat2) * 69.1, F.lit(2)) + F.pow((lon1 - lon2) * 53, F.lit(2))
    return F.coalesce(F.sqrt(squared).cast("decimal(8,2)"), F.lit(-1).cast("decimal(8,2)"))


def distance_band(miles: Column) -> Column:
    bands = [
        ("0", "4.99", "1: 0 - 4.99 MILES"), ("4.99", "9.99", "2: 5 - 9.99 MILES"),
        ("9.99", "14.99", "3: 10 - 14.99 MILES"), ("14.99", "19.99", "4: 15 - 19.99 MILES"),
        ("19.99", "29.99", "5: 20 - 29.99 MILES"), ("29.99", "39.99", "6: 30 - 39.99 MILES"),
        ("39.99", "49.99", "7: 40 - 49.99 MILES"), ("49.99", "74.99", "8: 50 - 75 MILES"),
        ("75.00", "99.99", "9: 75 - 100 MILES"), ("100.00", "149.99", "10: 100 - 150 MILES"),
    ]
    edge = lambda text: F.lit(text).cast("decimal(8,2)")
    chain = F
    for low, high, label in bands:
        chain = chain.when(miles.between(edge(low), edge(high)), label)
    return chain.when(miles > edge("149.99"), "11: 150+ MILES").otherwise("12: UNKNOWN")


def photo_days(entry: Column, photo: Column) -> Column:
    return F.datediff(photo, entry)


def photo_band(days: Column) -> Column:
    return (
        F.when(days <= 5, "0-5 Days")
        .when((days > 5) & (days <= 10), "6-10 Days")
        .when(days > 10, "Above 10 Days")
        .otherwise("NA")
    )


def ev_flag(fuel: Column) -> Column:
    return F.when(F.upper(fuel) == M.ELECTRIC_FUEL.upper(), "EV").otherwise("ICE")


def ev_flag_strict(flag: Column, fuel: Column) -> Column:
    return F.when((flag == "EV") & fuel.isin(*M.ELECTRIFIED_FUELS), "EV").otherwise("Non-EV")


# --- own stores and competition ------------------------------------------------


def store_or_competition(store: Column, blank_is_competition: bool) -> Column:
    missing = store.isNull()
    if blank_is_competition:
        missing = missing | (store == "")
    return F.when(missing, "Competition").otherwise(store)


def split_measure(store: Column, measure: Column) -> tuple[Column, Column]:
    """(competition, own) parts of a measure."""
    rival = store == "Competition"
    zero = F.lit(0).cast("long")
    return F.when(rival, measure).otherwise(zero), F.when(rival, zero).otherwise(measure)
