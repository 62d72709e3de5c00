"""Organisation, lead, acquisition, photo and referral reports on the driver's tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from lotwise.functions import classify as C
from lotwise.functions import text as TX
from lotwise.operators import matching as MT
from lotwise.operators.lookup import lookup
from lotwise.plans import leads as L
from lotwise.plans import upkeep as K
from lotwise.session import new_path
from lotwise.sources.sinks import replace_partitions

from .base import register
from .roles import EVENT_AS_OF

# --- organisation -------------------------------------------------------------------


def _entities(t):
    stores = t.stores.select(
        F.concat(F.lit("S"), "store_id").alias("entity_id"), F.concat(F.lit("N"), "market_eid").alias("parent_id"),
        F.lpad("store_id", 4, "0").alias("store_id"),
        F.concat("manufacturer_name", F.lit(" North "), "store_name").alias("entity_name"), F.lit("h").alias("entity_type"),
        F.lower("store_status").alias("status"), F.col("manufacturer_key").cast("string").alias("manufacturer_code"),
        F.col("market_name").alias("city"), F.col("region_name").alias("state"),
    )
    columns = stores.columns
    none = F.lit(None).cast("string")
    markets = t.nation.select(
        F.concat(F.lit("N"), "n_nationkey").alias("entity_id"), F.concat(F.lit("R"), "n_regionkey").alias("parent_id"),
        F.concat(F.lit("M"), "n_nationkey").alias("store_id"), F.col("n_name").alias("entity_name"), F.lit("m").alias("entity_type"),
        F.lit("open").alias("status"), none.alias("manufacturer_code"), none.alias("city"), none.alias("state"),
    )
    regions = t.region.select(
        F.concat(F.lit("R"), "r_regionkey").alias("entity_id"), none.alias("parent_id"),
        F.concat(F.lit("R"), "r_regionkey").alias("store_id"),
        F.when(F.col("r_name") == "AFRICA", "Corporate").otherwise(F.col("r_name")).alias("entity_name"), F.lit("r").alias("entity_type"),
        F.lit("open").alias("status"), none.alias("manufacturer_code"), none.alias("city"), none.alias("state"),
    )
    return stores.select(columns).unionByName(markets).unionByName(regions)


_ORG = f"""SELECT lpad(store_id, 4, '0') AS store_id, manufacturer_name || ' North ' || store_name AS store_name, region_name, market_name,
  coalesce(m.segment, 'Other Entity') AS segment, coalesce(m.dominant_brand, 'Other Entity') AS brand_group,
  CASE WHEN m.dominant_brand IS NULL THEN 'Other Entity' WHEN manufacturer_name = 'Acura' THEN 'Other Imports'
    WHEN m.dominant_brand = 'Other Luxury' THEN manufacturer_name ELSE m.dominant_brand END AS brand_group_2,
  CASE WHEN m.dominant_brand IN ('Chrysler','Ford','GM') THEN m.dominant_brand ELSE manufacturer_name END AS brand,
  'M' || market_eid AS market_id, 'R' || region_eid AS region_id, m.manufacturer_group, market_name AS city, region_name AS state,
  replace(replace(replace(replace(replace(replace(replace(replace(manufacturer_name || ' North ' || store_name, 'Mercedes-Benz', 'MB'),
    'Chrysler ', 'C'), 'Dodge ', 'D'), 'Jeep ', 'J'), 'Ram ', 'R'), 'Chevrolet', 'Chevy'), 'Volkswagen', 'VW'), 'North', 'N') AS store_name_short,
  'NA' AS geo_area
FROM stores s JOIN makers m USING (manufacturer_name) WHERE store_status = 'OPEN' AND region_name <> 'AFRICA'"""
_ORG_SPEC = ("store_id store_name region_name market_name segment brand_group brand_group_2 brand market_id region_id manufacturer_group city "
             "state store_name_short geo_area")
register("org_hierarchy", _ORG_SPEC, lambda t: L.org_map(_entities(t), t.makers), _ORG, ("stores", "makers"))
register(
    "short_names", "store_name store_name_short",
    lambda t: _entities(t).filter("entity_type = 'h'").select(
        F.col("entity_name").alias("store_name"), TX.replace_all(F.col("entity_name"), L.STORE_NAME_SHORTS).alias("store_name_short")
    ),
    """SELECT manufacturer_name || ' North ' || store_name AS store_name, replace(replace(replace(replace(replace(replace(replace(
      manufacturer_name || ' North ' || store_name, 'Chrysler ', 'C'), 'Dodge ', 'D'), 'Jeep ', 'J'), 'Ram ', 'R'), 'Chevrolet', 'Chevy'),
      'Volkswagen', 'VW'), 'North', 'N') AS store_name_short FROM stores""", ("stores",),
)

# --- leads ----------------------------------------------------------------------------

MARKETS = [f"NATION_{i}" for i in range(20)]
_MARKETS = "market_name IN (" + ", ".join(f"'{m}'" for m in MARKETS) + ")"


def _lead_dims(t):
    stores = t("stores", "store_eid store_id store_name market_eid region_eid manufacturer_key zip")
    providers = t.events.select(F.col("event_type").alias("provider_key")).distinct()
    subproviders = t.leads.select("subprovider_key").distinct()
    return {
        "store": stores.select("store_eid", "store_id", "store_name", "market_eid", "region_eid", "manufacturer_key", "zip"),
        "market": t.nation.select(F.col("n_nationkey").alias("market_eid"), F.col("n_name").alias("market_name")),
        "region": t.region.select(F.col("r_regionkey").alias("region_eid"), F.col("r_name").alias("region_name")),
        "manufacturer": t.makers.select(F.col("man_id").cast("int").alias("manufacturer_key"), "manufacturer_name"),
        "provider": providers.withColumn(
            "provider_name",
            F.when(F.col("provider_key") == "view", "WBYC-Showroom").when(F.col("provider_key") == "click", "Cargurus")
            .otherwise(F.col("provider_key")),
        ),
        "subprovider": subproviders.withColumn(
            "subprovider_name",
            F.element_at(F.array(*[F.lit(x) for x in ("WBYC Sell Only", "Dealer Website – WBYC", "Sell my car", "Other")]),
                         F.col("subprovider_key") + 1),
        ),
    }


def _enriched(t):
    return L.enrich_leads(t.leads, _lead_dims(t))


_LEAD_ROLES = ("leads", "stores")
_ENRICHED = """enriched AS (SELECT l.*, s.store_id, s.store_name, s.market_name, s.region_name, s.zip, s.manufacturer_name,
    CASE provider_key WHEN 'view' THEN 'WBYC-Showroom' WHEN 'click' THEN 'Cargurus' ELSE provider_key END AS provider_name,
    list_value('WBYC Sell Only', 'Dealer Website – WBYC', 'Sell my car', 'Other')[subprovider_key + 1] AS subprovider_name
  FROM leads l LEFT JOIN stores s ON s.store_eid = l.store_eid)"""
register(
    "lead_star", "lead_id:i activity_date:t store_id market_name region_name manufacturer_name provider_name subprovider_name lead_group "
    "reporting_group reporting_subgroup final_group purchase_count:i",
    lambda t: _enriched(t).withColumn(
        "reporting_group", C.lead_group(F.col("lead_group"), F.col("provider_name"), F.col("subprovider_name"))
    ).withColumn("reporting_subgroup", C.lead_subgroup(F.col("lead_group"), F.col("subprovider_name")))
    .withColumn("final_group", C.lead_final(F.col("reporting_group"))),
    """SELECT *, CASE WHEN reporting_group IN ('OWN SITE SELL ONLY LEAD', 'KBB INSTANT CASH OFFER') THEN reporting_group ELSE 'WBYC-OTHER' END AS final_group
    FROM (SELECT *, CASE WHEN lead_group LIKE '%(VOI)' THEN 'NON-WBYC LEAD'
        WHEN lead_group LIKE '%SELL ONLY' AND upper(provider_name) <> 'WBYC-SHOWROOM' THEN 'OWN SITE SELL ONLY LEAD'
        WHEN subprovider_name = 'Sell my car' AND provider_name = 'Cargurus' THEN 'CARGURUS-Sell My Car'
        WHEN lead_group = 'UNKNOWN' THEN 'NON-WBYC LEAD' ELSE lead_group END AS reporting_group,
      CASE WHEN lead_group LIKE '%SELL ONLY' THEN CASE subprovider_name WHEN 'WBYC Sell Only' THEN 'WBYC-Own site'
        WHEN 'Dealer Website – WBYC' THEN 'WBYC-OEM Sites' END END AS reporting_subgroup FROM enriched) x""", _LEAD_ROLES, _ENRICHED,
)
register(
    "credit_split", "year:i month:i region_name associate purchases:d",
    lambda t: L.associate_credit(_enriched(t), date(2024, 1, 1), EVENT_AS_OF, MARKETS),
    f"""SELECT year, month, region_name, associate, sum(p) AS purchases FROM (
      SELECT year(activity_date) AS year, month(activity_date) AS month, region_name, associate_1 AS associate, sum(purchase_count) * 1.0 AS p
      FROM enriched WHERE {_MARKETS} AND associate_2 IS NULL GROUP BY 1, 2, 3, 4
      UNION ALL SELECT year(activity_date), month(activity_date), region_name, associate_2, sum(purchase_count * 0.5)
      FROM enriched WHERE {_MARKETS} AND associate_2 IS NOT NULL AND program_id IS NOT NULL GROUP BY 1, 2, 3, 4
      UNION ALL SELECT year(activity_date), month(activity_date), region_name, associate_1, sum(purchase_count * 0.5)
      FROM enriched WHERE {_MARKETS} AND associate_2 IS NOT NULL AND program_id IS NOT NULL GROUP BY 1, 2, 3, 4) z
    GROUP BY 1, 2, 3, 4""", _LEAD_ROLES, _ENRICHED,
)


def _funnel(t):
    rows = t("sales_detail", "accounting_month market_name store_name department sold_count fi_count auction_count").select(
        F.month("accounting_month").alias("month"), "market_name", F.col("store_name").alias("store"), "department",
        F.col("sold_count").alias("opportunities"), F.col("fi_count").alias("sales"), F.col("auction_count").alias("first_visit_count"),
    )
    return L.funnel(rows, ["opportunities", "sales", "first_visit_count"])


register(
    "funnel_sums", "month:i market_name store department opportunities:i sales:i first_visit_count:i", _funnel,
    """SELECT month(accounting_month) AS month, market_name, store_name AS store, department, sum(sold_count) AS opportunities,
      sum(fi_count) AS sales, sum(auction_count) AS first_visit_count FROM sales_detail WHERE upper(department) = 'USED' GROUP BY 1, 2, 3, 4""",
    ("sales_detail",),
)
register(
    "acquisitions_by_group", "month:i consolidated_group vin acquisitions:i units_sold:i",
    lambda t: L.acquisitions(t.acquired, date(2023, 1, 1), EVENT_AS_OF),
    """SELECT month(acquisition_date) AS month, CASE source_grouped WHEN 'Rental company' THEN 'Auction/Rental' WHEN 'LEASEBUYOUT' THEN 'Lease Return'
      WHEN 'TRADE-IN-USED' THEN 'Trade-In' WHEN 'WBYC' THEN 'WBYC' ELSE 'NONE' END AS consolidated_group, vin,
      sum(acquisition_count) AS acquisitions, sum(sold_count) AS units_sold FROM acquired
    WHERE acquisition_date BETWEEN DATE '2023-01-01' AND DATE '2024-01-30' GROUP BY 1, 2, 3""", ("acquired",),
)


def _acquired(t):
    stores = t("stores", "store_eid store_id store_name market_name region_name manufacturer_name")
    return t.acquired.join(stores, "store_eid", "left")


_MARK = """marked AS (SELECT DISTINCT lead_id FROM leads WHERE lead_group LIKE '%(VOI)' AND purchase_count >= 1)"""
register(
    "marker_left_join", "lead_group lead_count:i opportunities:i",
    lambda t: (
        lambda bought: t.leads.join(bought, "lead_id", "left").groupBy("lead_group").agg(
            F.sum(L.lead_measure(F.col("opportunities"), F.col("lead_group"), F.col("_bought"))).alias("lead_count"),
            F.sum("opportunities").alias("opportunities"),
        )
    )(t.leads.filter(F.col("lead_group").isin(*L.VOI_GROUPS) & (F.col("purchase_count") >= 1)).select("lead_id").distinct()
      .withColumn("_bought", F.lit(1))),
    """SELECT lead_group, sum(CASE WHEN lead_group LIKE '%(VOI)' AND m.lead_id IS NULL THEN 0 ELSE opportunities END) AS lead_count,
      sum(opportunities) AS opportunities FROM leads l LEFT JOIN marked m ON m.lead_id = l.lead_id GROUP BY 1""", ("leads",), _MARK,
)
register(
    "lead_acquisition_stack", "year:i month:i vin reporting_group lead_count:i acquisitions:i acquisition_count:i reporting_group_final",
    lambda t: L.lead_acquisition_stack(_enriched(t), _acquired(t), EVENT_AS_OF, MARKETS),
    f"""SELECT year, month, vin, g AS reporting_group, lead_count, acquisitions, acquisition_count,
      CASE WHEN g IN ('OWN SITE SELL ONLY LEAD', 'KBB INSTANT CASH OFFER') THEN g ELSE 'WBYC-OTHER' END AS reporting_group_final FROM (
      SELECT year(activity_date) AS year, month(activity_date) AS month, vin, region_name, market_name, store_id, manufacturer_name, associate_1,
        associate_2, CASE WHEN lead_group LIKE '%(VOI)' THEN 'NON-WBYC LEAD'
          WHEN lead_group LIKE '%SELL ONLY' AND upper(provider_name) <> 'WBYC-SHOWROOM' THEN 'OWN SITE SELL ONLY LEAD'
          WHEN subprovider_name = 'Sell my car' AND provider_name = 'Cargurus' THEN 'CARGURUS-Sell My Car'
          WHEN lead_group = 'UNKNOWN' THEN 'NON-WBYC LEAD' ELSE lead_group END AS g,
        CASE WHEN lead_group LIKE '%SELL ONLY' AND subprovider_name IN ('WBYC Sell Only', 'Dealer Website – WBYC') THEN subprovider_name END AS sg,
        sum(CASE WHEN lead_group LIKE '%(VOI)' AND m.lead_id IS NULL THEN 0 ELSE opportunities END) AS lead_count,
        sum(purchase_count) AS acquisitions, 0 AS acquisition_count
      FROM enriched e LEFT JOIN marked m ON m.lead_id = e.lead_id
      WHERE activity_date BETWEEN DATE '2023-08-01' AND DATE '2024-01-30' AND {_MARKETS} GROUP BY ALL
      UNION ALL
      SELECT year(trx_date), month(trx_date), vin, region_name, market_name, store_id, manufacturer_name, NULL, NULL, NULL, NULL, 0, 0, sum(acquisition_count)
      FROM acquired a LEFT JOIN stores s ON s.store_eid = a.store_eid WHERE trx_date BETWEEN DATE '2023-08-01' AND DATE '2024-01-30' AND {_MARKETS}
      GROUP BY ALL HAVING sum(acquisition_count) + sum(sold_count) > 0) x
    WHERE lead_count <> 0 OR acquisitions <> 0 OR acquisition_count <> 0""", ("leads", "stores", "acquired"), f"{_ENRICHED}, {_MARK}",
)


def _spend(t):
    placed = _acquired(t)
    return placed.select(
        F.year("trx_date").alias("yr"), F.month("trx_date").alias("mnth"), "market_name", "lead_group", F.col("amount").alias("adv_spend")
    )


def _distance(t):
    stores = t("stores", "store_eid zip market_name")
    return L.spend_and_distance(
        t.leads, stores, t.zip_points, _spend(t), date(2024, 1, 1), date(2024, 1, 29), MARKETS, [2023, 2024]
    )


_BAND = " ".join(
    f"WHEN dist BETWEEN {a} AND {b} THEN '{label}'"
    for a, b, label in [("0", "4.99", "1: 0 - 4.99 MILES"), ("4.99", "9.99", "2: 5 - 9.99 MILES"), ("9.99", "14.99", "3: 10 - 14.99 MILES"),
                        ("14.99", "19.99", "4: 15 - 19.99 MILES"), ("19.99", "29.99", "5: 20 - 29.99 MILES"), ("29.99", "39.99", "6: 30 - 39.99 MILES"),
                        ("39.99", "49.99", "7: 40 - 49.99 MILES"), ("49.99", "74.99", "8: 50 - 75 MILES"), ("75.00", "99.99", "9: 75 - 100 MILES"),
                        ("100.00", "149.99", "10: 100 - 150 MILES")]
)
register(
    "distance_bands", "yr:i mnth:i market_name lead_group distance_band opportunities:i purchase_count:i spend:d", _distance,
    f"""SELECT year(activity_date) AS yr, month(activity_date) AS mnth, market_name, lead_group,
      CASE {_BAND} WHEN dist > 149.99 THEN '11: 150+ MILES' ELSE '12: UNKNOWN' END AS distance_band,
      sum(opportunities) AS opportunities, sum(purchase_count) AS purchase_count, 0 AS spend
    FROM (SELECT l.*, s.market_name, coalesce(CAST(sqrt(pow((cz.latitude - sz.latitude) * 69.1, 2) + pow((cz.longitude - sz.longitude) * 53, 2))
        AS DECIMAL(8,2)), -1) AS dist
      FROM leads l LEFT JOIN stores s ON s.store_eid = l.store_eid LEFT JOIN zip_points sz ON sz.zip_code = left(s.zip, 5)
      LEFT JOIN zip_points cz ON cz.zip_code = left(l.cust_zip_code, 5) WHERE activity_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-29') d
    GROUP BY 1, 2, 3, 4, 5 HAVING sum(opportunities) <> 0 OR sum(purchase_count) <> 0
    UNION SELECT year(trx_date), month(trx_date), market_name, lead_group, NULL, 0, 0, sum(amount) FROM acquired a
      LEFT JOIN stores s ON s.store_eid = a.store_eid WHERE {_MARKETS} AND year(trx_date) IN (2023, 2024) GROUP BY 1, 2, 3, 4 HAVING sum(amount) > 0""",
    ("leads", "stores", "zip_points", "acquired"),
)

# --- photos -------------------------------------------------------------------------------

_P0, _P1 = date(1997, 1, 1), date(1999, 12, 31)
register(
    "speed_bands_distinct", "mth:i store_id flag vin_count:i",
    lambda t: L.speed_bands(t.photo_trend, t("unit_snapshots", "vin stock_type valid_for_group status image_type"), _P0, _P1),
    """SELECT month(snapshot_date) AS mth, store_id, CASE WHEN d <= 5 THEN '0-5 Days' WHEN d <= 10 THEN '6-10 Days' ELSE 'Above 10 Days' END AS flag,
      count(DISTINCT vin) AS vin_count
    FROM (SELECT DISTINCT i.snapshot_date, i.store_id, i.vin, i.entry_date, i.photo_date, date_diff('day', i.entry_date, i.photo_date) AS d
      FROM photo_trend i JOIN unit_snapshots s ON s.vin = i.vin WHERE i.snapshot_date BETWEEN DATE '1997-01-01' AND DATE '1999-12-31'
        AND upper(s.stock_type) = 'USED' AND s.valid_for_group = 1 AND s.status = 'S' AND s.image_type <> 'StockPhotos'
        AND i.photo_date >= i.entry_date AND date_diff('day', i.entry_date, i.photo_date) <= 30) x GROUP BY 1, 2, 3""",
    ("photo_trend", "unit_snapshots"),
)


def _stored_speed(t):
    """Monthly states stored by month, one month loaded twice; the estimate of two years' span per store and per band
    against the exact count, within four standard errors or half a unit."""
    photos, daily = t.photo_trend, t("unit_snapshots", "vin stock_type valid_for_group status image_type")
    path = new_path(t.spark, "speed-states")
    states = L.speed_band_states(photos, daily, _P0, _P1)
    replace_partitions(states, path, ["snapshot_month"])
    replace_partitions(states.filter("snapshot_month = '1998-03-01'"), path, ["snapshot_month"])
    stored = t.spark.read.schema(states.schema).parquet(path)
    first, last = date(1997, 7, 1), date(1999, 6, 1)
    exact = L.speed_bands(photos, daily, date(1997, 7, 1), date(1999, 6, 30), ["store_id", "flag"])
    by_store = L.speed_bands_over(stored, first, last).withColumnRenamed("vin_count", "estimate")
    by_band = L.speed_bands_over(stored, first, last, ["flag"]).withColumnRenamed("vin_count", "estimate")
    band_exact = L.speed_bands(photos, daily, date(1997, 7, 1), date(1999, 6, 30), ["flag"])
    both = exact.join(by_store, ["store_id", "flag"], "full").unionByName(
        band_exact.join(by_band, "flag", "full"), allowMissingColumns=True
    )
    return both.withColumn("within", F.abs(F.col("estimate") - F.col("vin_count")) <= F.greatest(F.lit(0.5), 4 * 0.01625 * F.col("vin_count")))


register(
    "speed_bands_states", "store_id flag vin_count:i within:b", _stored_speed,
    """SELECT store_id, flag, count(DISTINCT vin) AS vin_count, true AS within
    FROM (SELECT DISTINCT i.store_id, i.vin, CASE WHEN d <= 5 THEN '0-5 Days' WHEN d <= 10 THEN '6-10 Days' ELSE 'Above 10 Days' END AS flag
      FROM (SELECT *, date_diff('day', entry_date, photo_date) AS d FROM photo_trend) i JOIN unit_snapshots s ON s.vin = i.vin
      WHERE i.snapshot_date BETWEEN DATE '1997-07-01' AND DATE '1999-06-30' AND upper(s.stock_type) = 'USED' AND s.valid_for_group = 1 AND s.status = 'S'
        AND s.image_type <> 'StockPhotos' AND d BETWEEN 0 AND 30) x GROUP BY GROUPING SETS ((store_id, flag), (flag))""",
    ("photo_trend", "unit_snapshots"),
)
_COUNTED = "snapshot_date > DATE '1997-01-01' AND photo_date IS NOT NULL AND entry_date <= photo_date AND d"


def _pair(name: str, test: str) -> str:
    return (f"coalesce(sum(CASE WHEN {_COUNTED} {test} THEN d END), 0) AS {name}_num, "
            f"sum(CASE WHEN {_COUNTED} {test} THEN 1 ELSE 0 END) AS {name}_den")


register(
    "duration_components",
    "snapshot_month:t store_id under_5_num:d under_5_den:d under_10_num:d under_10_den:d above_10_num:d above_10_den:d all_num:d all_den:d",
    lambda t: L.speed_components(t("photo_trend", "snapshot_date store_id entry_date photo_date"), t("stores", "store_id"), _P0, _P1),
    f"""SELECT CAST(date_trunc('month', snapshot_date) AS DATE) AS snapshot_month, store_id, {_pair('under_5', '<= 5')},
      {_pair('under_10', '> 5 AND d <= 10')}, {_pair('above_10', '> 10 AND d <= 30')}, {_pair('all', '<= 30')}
    FROM (SELECT p.*, date_diff('day', entry_date, photo_date) AS d FROM photo_trend p JOIN stores s ON s.store_id = p.store_id) x
    WHERE snapshot_date BETWEEN DATE '1997-01-01' AND DATE '1999-12-31' GROUP BY 1, 2""", ("photo_trend", "stores"),
)

# --- referrals --------------------------------------------------------------------------------

_PAIRS = """flags AS (SELECT f.form_id, c.cust_no, f.email AS form_email,
    CASE WHEN upper(c.email) = upper(f.email) AND f.email <> '' THEN 1 END AS e,
    CASE WHEN c.phone = regexp_replace(f.phone, '[^0-9]', '', 'g') THEN 1 END AS p,
    CASE WHEN contains(upper(c.first_name), upper(f.first_name)) AND contains(upper(c.last_name), upper(replace(f.last_name, '''', ''))) THEN 1 END AS n
  FROM referral_form f JOIN customers c ON c.market_id = left(f.market_id, 4)
  WHERE upper(c.email) = upper(f.email) OR c.phone = regexp_replace(f.phone, '[^0-9]', '', 'g')),
 strong AS (SELECT * FROM flags WHERE coalesce(e, 0) + coalesce(p, 0) + coalesce(n, 0) >= 2)"""
_MATCH_SPEC = "form_id:i cust_no email_match phone_match name_match"
_MATCH_SQL = """SELECT form_id, cust_no, CASE WHEN e = 1 THEN 'Email_match' END AS email_match, CASE WHEN p = 1 THEN 'Phone_match' END AS phone_match,
  CASE WHEN n = 1 THEN 'name_match' END AS name_match FROM strong"""


_SOLD_SINCE = date(1999, 7, 1)


def _matches(t):
    deals = t("sales_detail", "cust_no accounting_month sale_type deal_no front_gross")
    return K.referral_matches(t.referral_form, t.customers, deals, _SOLD_SINCE)


register(
    "record_match", _MATCH_SPEC,
    lambda t: MT.match_people(t.referral_form, t.customers), _MATCH_SQL, ("referral_form", "customers"), _PAIRS,
)
register(
    "record_match_hot_keys", _MATCH_SPEC, lambda t: MT.match_people(t.referral_form, t.customers, pairs_per_row=0), _MATCH_SQL,
    ("referral_form", "customers"), _PAIRS,
)
register(
    "referral_sales", "form_id:i cust_no deal_no accounting_month:t front_gross:d email_match phone_match name_match", _matches,
    f"""SELECT m.*, d.deal_no, d.accounting_month, d.front_gross FROM ({_MATCH_SQL}) m JOIN sales_detail d ON d.cust_no = m.cust_no
    WHERE d.accounting_month >= DATE '1999-07-01' AND d.sale_type = 'VehicleSale'""", ("referral_form", "customers", "sales_detail"), _PAIRS,
)


def _new_referrals(t):
    people = t.customers.select("cust_no", F.upper("email").alias("email"), F.col("phone").alias("telephone"))
    matches = MT.match_people(t.referral_form, t.customers).join(people, "cust_no").select("form_id", "cust_no", "email", "telephone")
    previous = t.customers.filter("cust_no < '3'").select(F.col("phone").alias("telephone"))
    form = lookup(
        t.referral_form.select("form_id", F.upper("email").alias("email")), t.referral_form, ["form_id"], ["submitter_email"]
    ).groupBy("email").agg(F.min("submitter_email").alias("submitter_email"))
    deals = t("sales_detail", "cust_no accounting_month sale_type deal_no")
    return K.sold_since(K.new_referrals(matches, previous, form), deals, _SOLD_SINCE)


register(
    "exclude_seen", "employee_email form_id:i cust_no deal_no email telephone", _new_referrals,
    """SELECT b.submitter AS employee_email, m.form_id, m.cust_no, d.deal_no, upper(c.email) AS email, c.phone AS telephone
    FROM strong m JOIN sales_detail d ON d.cust_no = m.cust_no JOIN customers c ON c.cust_no = m.cust_no
    LEFT JOIN (SELECT upper(email) AS email, min(submitter_email) AS submitter FROM referral_form GROUP BY 1) b ON b.email = upper(c.email)
    WHERE d.accounting_month >= DATE '1999-07-01' AND d.sale_type = 'VehicleSale' AND c.phone NOT IN (SELECT phone FROM customers WHERE cust_no < '3')""",
    ("referral_form", "customers", "sales_detail"), _PAIRS,
)
