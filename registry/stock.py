"""Inventory and used-vehicle reports on the driver's tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from lotwise.functions import classify as C
from lotwise.functions import dates as D
from lotwise.operators import windows as W
from lotwise.plans import inventory as I
from lotwise.plans import used as U

from . import rules_sql as S
from .base import register
from .roles import AS_OF, EVENT_AS_OF

MONTH = D.closed_month(AS_OF)  # 1999-07-01
M = f"DATE '{MONTH}'"
CURRENT = D.month_start(AS_OF)
THREE_BACK = D.add_months(CURRENT, -3)
MARKETS = ["NATION_3", "nation_7"]
R0 = "EUROPE"


def _inv_vs_sales(keys: str, electric: str, having: str) -> str:
    return f"""SELECT accounting_month, {keys} {S.brand_rollup()} AS brand,
      sum(CASE WHEN t = 'Inv' THEN q ELSE 0 END) AS inv, sum(CASE WHEN t = 'Sales' THEN q ELSE 0 END) AS sales
    FROM (SELECT accounting_month, {keys} make, 'Inv' AS t, sum(inventory_count) AS q FROM inventory_month
          WHERE accounting_month = {M} AND department = '300' {electric} GROUP BY ALL HAVING sum(inventory_count) <> 0
          UNION ALL
          SELECT accounting_month, {keys} make, 'Sales', sum(sold_count) FROM sales_detail
          WHERE accounting_month = {M} AND upper(department) = 'NEW' AND record_source = 'Accounting' {electric}
          GROUP BY ALL HAVING sum(sold_count) <> 0) x
    WHERE make IS NOT NULL GROUP BY ALL {having}"""


_ELECTRIC = "AND fuel_type = 'Electric Fuel System'"
_PAIR = ("inventory_month", "sales_detail")
register(
    "inventory_vs_sales_pivot", "accounting_month:t store_id store_name brand inv:i sales:i",
    lambda t: I.inventory_vs_sales(t("inventory_month", "accounting_month store_id store_name make fuel_type department inventory_count"), t("sales_detail", "accounting_month store_id store_name make fuel_type department record_source sold_count"), MONTH, min_inventory=0),
    _inv_vs_sales("store_id, store_name,", "", "HAVING sum(CASE WHEN t = 'Inv' THEN q ELSE 0 END) > 0"), _PAIR,
)
register(
    "inventory_vs_sales_electric", "accounting_month:t store_id store_name brand inv:i sales:i",
    lambda t: I.inventory_vs_sales(t("inventory_month", "accounting_month store_id store_name make fuel_type department inventory_count"), t("sales_detail", "accounting_month store_id store_name make fuel_type department record_source sold_count"), MONTH, electric_only=True, min_inventory=None),
    _inv_vs_sales("store_id, store_name,", _ELECTRIC, ""), _PAIR,
)
register(
    "inventory_vs_sales_brand", "accounting_month:t brand inv:i sales:i",
    lambda t: I.inventory_vs_sales(t("inventory_month", "accounting_month make department inventory_count"), t("sales_detail", "accounting_month make department record_source sold_count"), MONTH, by_store=False),
    _inv_vs_sales("", "", "HAVING sum(CASE WHEN t = 'Inv' THEN q ELSE 0 END) > 5"), _PAIR,
)
register(
    "electric_flags", "allocation_group ev_flag",
    lambda t: I.electric_flags(t("inventory_month", "accounting_month department allocation_group fuel_type"), AS_OF),
    f"""SELECT DISTINCT allocation_group, CASE WHEN fuel_type = 'Electric Fuel System' THEN 'EV' ELSE 'ICE' END AS ev_flag
    FROM inventory_month WHERE accounting_month >= DATE '1999-02-01' AND department = '300'""", ("inventory_month",),
)

SPINE = """brands AS (SELECT unnest(['CDJR','Ford','GM','Acura','Honda','Hyundai','INFINITI','Mazda','Nissan','Subaru','Toyota',
  'Volkswagen','Volvo','Aston Martin','Audi','BMW','Bentley','JLR','Lexus','Mercedes-Benz','MINI','Porsche','Others']) AS brand)"""


def _spine(filter_sql: str) -> str:
    return f"""SELECT b.brand, coalesce(s.category, i.category, 'Others') AS category, m.accounting_month AS date,
      coalesce(i.inv, 0) AS inv, coalesce(s.sold, 0) AS sales
    FROM brands b CROSS JOIN (SELECT DISTINCT accounting_month FROM inventory_month
        WHERE department = '300' AND status <> 'G' AND {filter_sql}) m
    LEFT JOIN (SELECT accounting_month, {S.brand_spine()} AS brand, {S.segment_spine()} AS category, sum(inventory_count) AS inv
        FROM inventory_month WHERE department = '300' AND status <> 'G' AND {filter_sql} GROUP BY ALL) i
      ON i.brand = b.brand AND i.accounting_month = m.accounting_month
    LEFT JOIN (SELECT accounting_month, {S.brand_spine()} AS brand, {S.segment_spine()} AS category, sum(sold_count) AS sold
        FROM sales_detail WHERE department = 'New' AND {filter_sql} GROUP BY ALL) s
      ON s.brand = b.brand AND s.accounting_month = m.accounting_month"""


register(
    "dense_brand_spine", "brand category date:t inv:i sales:i",
    lambda t: I.others_last(I.dense_brand_inventory(t("inventory_month", "accounting_month make department status inventory_count"), t("sales_detail", "accounting_month make department sold_count"), [MONTH, CURRENT])),
    _spine(f"accounting_month IN ({M}, DATE '{CURRENT}')"), _PAIR, SPINE,
)
register(
    "brand_segment_monthly", "brand category date:t inv:i sales:i",
    lambda t: I.dense_brand_inventory(t("inventory_month", "accounting_month make department status inventory_count"), t("sales_detail", "accounting_month make department sold_count")),
    _spine("accounting_month BETWEEN DATE '1995-01-01' AND DATE '2001-11-30'"), _PAIR, SPINE,
)
register(
    "discount_measures",
    "accounting_month:t vin inventory_count:i store_name make days_in_inventory_group:i msrp:d price_tier_93:d "
    "price_tier_95:d price_tier_99:d is_discounted:i website_discount:d ecom_discount:d incentives:d total_discount:d "
    "is_aged:i aged_count:i aged_and_discounted:i aged_not_discounted:i brand category",
    lambda t: I.pricing(t.inventory_month, MONTH, R0),
    f"""SELECT *, CASE WHEN disc THEN 1 ELSE 0 END AS is_discounted, msrp - price_tier_93 AS website_discount,
      msrp - price_tier_95 AS ecom_discount, price_tier_95 - price_tier_99 AS incentives,
      (msrp - price_tier_95) + (price_tier_95 - price_tier_99) AS total_discount,
      CASE WHEN days_in_inventory_group > 90 THEN 1 ELSE 0 END AS is_aged,
      CASE WHEN days_in_inventory_group > 90 THEN inventory_count ELSE 0 END AS aged_count,
      CASE WHEN days_in_inventory_group > 90 AND disc THEN inventory_count ELSE 0 END AS aged_and_discounted,
      CASE WHEN days_in_inventory_group > 90 AND NOT disc THEN inventory_count ELSE 0 END AS aged_not_discounted,
      {S.brand_spine()} AS brand, {S.segment_spine()} AS category
    FROM (SELECT *, (price_tier_93 IS NOT NULL AND price_tier_93 < msrp) OR (price_tier_95 IS NOT NULL AND price_tier_95 < msrp) AS disc
      FROM inventory_month WHERE accounting_month = {M} AND upper(region_name) <> '{R0}' AND department = '300'
      AND lower(market_name) NOT IN ('market 97','market 98') AND msrp > 0 AND valid_for_group = 1 AND valid_for_pricing = 1
      AND inventory_count <> 0) x""", ("inventory_month",),
)
register(
    "aged_measures", "brand category units:i aged:i aged_discounted:i aged_undiscounted:i discount:d",
    lambda t: I.pricing(t.inventory_month, MONTH, R0).groupBy("brand", "category").agg(
        F.sum("inventory_count").alias("units"), F.sum("aged_count").alias("aged"),
        F.sum("aged_and_discounted").alias("aged_discounted"), F.sum("aged_not_discounted").alias("aged_undiscounted"),
        F.sum("total_discount").alias("discount"),
    ),
    f"""SELECT {S.brand_spine()} AS brand, {S.segment_spine()} AS category, sum(inventory_count) AS units,
      sum(CASE WHEN days_in_inventory_group > 90 THEN inventory_count ELSE 0 END) AS aged,
      sum(CASE WHEN days_in_inventory_group > 90 AND (price_tier_93 < msrp OR price_tier_95 < msrp) THEN inventory_count ELSE 0 END) AS aged_discounted,
      sum(CASE WHEN days_in_inventory_group > 90 AND NOT coalesce(price_tier_93 < msrp OR price_tier_95 < msrp, false) THEN inventory_count ELSE 0 END) AS aged_undiscounted,
      sum(msrp - price_tier_99) FILTER (WHERE price_tier_95 IS NOT NULL) AS discount
    FROM inventory_month WHERE accounting_month = {M} AND upper(region_name) <> '{R0}' AND department = '300'
      AND msrp > 0 AND valid_for_group = 1 AND valid_for_pricing = 1 AND inventory_count <> 0 GROUP BY ALL""",
    ("inventory_month",),
)

YEAR_BACK = D.add_months(CURRENT, -12)
_WINDOW = f"accounting_month BETWEEN DATE '{YEAR_BACK}' AND DATE '{CURRENT}'"
register(
    "arrivals_inventory", "accounting_month:t make model status entry_date:t store_name inventory_count:i",
    lambda t: I.arrivals_inventory(t("inventory_month", "accounting_month make model status entry_date store_name department balance inventory_count"), YEAR_BACK, CURRENT),
    f"""SELECT accounting_month, make, model, status, entry_date, store_name, sum(inventory_count) AS inventory_count
    FROM inventory_month WHERE department = '300' AND balance > 0 AND inventory_count > 0 AND {_WINDOW} GROUP BY ALL""",
    ("inventory_month",),
)
register(
    "arrivals_sales", "accounting_month:t make sold_mtd:i ex_service record_source store_name",
    lambda t: I.arrivals_sales(t("sales_detail", "accounting_month make sold_count ex_service record_source store_name department"), YEAR_BACK, CURRENT),
    f"""SELECT accounting_month, make, sum(sold_count) AS sold_mtd, ex_service, record_source, store_name
    FROM sales_detail WHERE lower(department) = 'new' AND sold_count <> 0 AND {_WINDOW} GROUP BY ALL""", ("sales_detail",),
)
register(
    "sold_by_service", "ex_service sold_mtd:i",
    lambda t: I.sold_by_service(t("sales_detail", "accounting_month ex_service department sold_count"), AS_OF),
    f"""SELECT ex_service, sum(sold_count) AS sold_mtd FROM sales_detail
    WHERE accounting_month = DATE '{CURRENT}' AND lower(department) = 'new' GROUP BY ex_service""", ("sales_detail",),
)
register(
    "inventory_by_status", "status accounting_month:t inventory_count:i",
    lambda t: I.inventory_by_status(t("inventory_month", "accounting_month status department balance inventory_count"), AS_OF),
    f"""SELECT status, accounting_month, sum(inventory_count) AS inventory_count FROM inventory_month
    WHERE accounting_month = DATE '{CURRENT}' AND balance <> 0 AND department = '300' GROUP BY ALL""", ("inventory_month",),
)
register(
    "pipeline_by_status", "make status update_date:t store_id orders:i",
    lambda t: I.pipeline_by_status(t.orders_daily, AS_OF),
    """SELECT make, status, update_date, store_id, count(order_number) AS orders FROM orders_daily
    WHERE update_date = DATE '1999-08-19' AND lower(status) <> 'ignore' GROUP BY ALL""", ("orders_daily",),
)

# --- used vehicles --------------------------------------------------------------

_D50 = "DATE '1999-07-01'"
_USED_HISTORY = f"""hist AS (SELECT vin, source FROM (SELECT vin, {S.source_group('original_source_code', 'source_code')} AS source,
   row_number() OVER (PARTITION BY vin ORDER BY snapshot_date DESC, store_id DESC,
     {S.source_group('original_source_code', 'source_code')} DESC) AS rn
   FROM unit_snapshots WHERE department = '320' AND snapshot_date BETWEEN {_D50} AND DATE '1999-08-20' AND status <> 'G') h WHERE rn = 1)"""
register(
    "used_inventory",
    "vin store_name inventory_source inventory_count:i price_bucket valid_price_bucket age_bucket balance:d target_price:d "
    "type_no:i type status accounting_month:t week week_flag:i source_side franchise_type collapsed_age_bucket as_of:t",
    lambda t: U.used_inventory(
        t.inventory_month, t.inventory_live,
        t("unit_snapshots", "vin snapshot_date store_id department status original_source_code source_code"), AS_OF, CURRENT, R0, MARKETS, "Supplier#00000000"
    ),
    f"""SELECT vin, store_name, CASE WHEN src IN ('LEASE RETURN','Other','SERVICE LOANER') THEN 'Others' WHEN src = 'TRADE-IN' THEN 'Trade'
        WHEN src = 'AUCTION/RENTAL' THEN 'Auction' ELSE src END AS inventory_source,
      inventory_count, price_bucket, valid_price_bucket, age_bucket, balance, target_price, type_no,
      CASE type_no WHEN 1 THEN 'MonthEnd' ELSE 'Live' END AS type, 'S Status' AS status, DATE '{CURRENT}' AS accounting_month,
      'Week 1' AS week, 1 AS week_flag,
      CASE WHEN src IN ('TRADE-IN','WBYC','LEASE RETURN','SERVICE LOANER') THEN 'Total: Int. Sourced' ELSE 'Total: Ext. Sourced' END AS source_side,
      CASE WHEN store_name LIKE 'Supplier#00000000%' THEN 'Non-Franchise' ELSE 'Franchise' END AS franchise_type,
      CASE WHEN age_bucket LIKE 'N/A%' THEN '01: 0-15' WHEN age_bucket LIKE '06:%' OR age_bucket LIKE '07:%' THEN '06: >90'
        ELSE age_bucket END AS collapsed_age_bucket, DATE '1999-08-20' AS as_of
    FROM (SELECT *, CASE WHEN vin IS NULL THEN 1 ELSE row_number() OVER (PARTITION BY vin ORDER BY type_no, store_name, age_bucket,
        price_bucket, src, valid_price_bucket, balance NULLS FIRST, target_price NULLS FIRST) END AS rn FROM (
      SELECT a.vin, store_name, region_name, market_name, store_id, year, make, model,
        {S.age_bucket('days_in_inventory_group')} AS age_bucket, {S.price_inclusive('price_tier_93', 'balance')} AS price_bucket,
        {S.valid('price_tier_93', 'balance', 'target_price')} AS valid_price_bucket,
        {S.source_group('original_source_code', 'source_type', 'h.source')} AS src,
        sum(inventory_count) AS inventory_count, sum(balance) AS balance, sum(target_price) AS target_price, 1 AS type_no
      FROM inventory_month a LEFT JOIN hist h ON h.vin = a.vin
      WHERE department = '320' AND accounting_month = DATE '{CURRENT}' AND upper(region_name) <> '{R0}'
        AND upper(market_name) NOT IN ('NATION_3','NATION_7') AND upper(status) = 'S'
      GROUP BY ALL HAVING sum(inventory_count) = 1
      UNION ALL
      SELECT a.vin, store_name, NULL, NULL, NULL, NULL, NULL, NULL, {S.age_bucket('days_in_inventory_group')},
        {S.price_open('price_tier_93')}, {S.valid('price_tier_93', 'balance', 'target_price')},
        {S.source_group('original_source_code', 'source_code', 'h.source')}, 1, balance, target_price, 2
      FROM inventory_live a LEFT JOIN hist h ON h.vin = a.vin WHERE upper(stock_type) = 'USED' AND valid_for_group = 1) u) z
    WHERE rn = 1""",
    ("inventory_month", "inventory_live", "unit_snapshots"), _USED_HISTORY,
)

_SOLD = ["sold_count", "interco_count", "wholesale_count", "cfs_count"]
_GROSS = ["base_gross", "interco_gross", "wholesale_gross", "retail_revenue", "interco_revenue", "wholesale_revenue", "cfs_gross", "ovi_gross"]
_USED_MONTH = "1999-06-01"
register(
    "used_sales_by_unit",
    "accounting_month:t quarter make market_name model store_id store_name vin " + " ".join(f"{c}:i" for c in _SOLD) + " "
    + " ".join(f"{c}:d" for c in _GROSS) + " source days_to_sell:i group_age store_age price_band cash_price:d cost:d "
    "target_price:d sold_count_adj:i",
    lambda t: U.used_sales(t.sales_detail, date(1999, 6, 1), ["AFRICA", "AMERICA", "ASIA"]),
    f"""SELECT accounting_month, 'Q2' AS quarter, make, market_name, model, store_id, store_name, vin, sold_count, interco_count,
      wholesale_count, cfs_count, base_gross, interco_gross, wholesale_gross, retail_revenue, interco_revenue, wholesale_revenue,
      cfs_gross, ovi_gross, source, ag * sold_count AS days_to_sell,
      CASE WHEN ag BETWEEN 0 AND 45 THEN '0-45' ELSE '>45' END AS group_age,
      CASE WHEN sa BETWEEN 0 AND 45 THEN '0-45' ELSE '>45' END AS store_age, {S.band('p', 'ic')} AS price_band,
      {S.gate('p', 'sold_count', 'p', 'tg', 'fc')} AS cash_price, {S.gate('fc', 'sold_count', 'p', 'tg', 'fc')} AS cost,
      {S.gate('tg', 'sold_count', 'p', 'tg', 'fc')} AS target_price, {S.gate('sc', 'sold_count', 'p', 'tg', 'fc')} AS sold_count_adj
    FROM (SELECT accounting_month, make, market_name, model, store_id, store_name, vin,
      CASE WHEN lower(code) IN ('active loaner','activeloaner','retiredloaner','manufacturer') THEN 'ExLoaner'
           WHEN lower(code) IN ('auction','caad','rental-co') THEN 'Auction'
           WHEN lower(code) IN ('dealer-trade','trade-in','trade-in-used') THEN 'Trade' WHEN lower(code) = 'inter-co' THEN 'Interco'
           WHEN lower(code) IN ('leasebuyout','leasestrpurch') THEN 'Lease Return' WHEN lower(code) = 'webuyyourcar' THEN 'WBYC'
           ELSE 'Other' END AS source,
      sum(sold_count) AS sold_count, sum(interco_count) AS interco_count, sum(auction_count) AS wholesale_count,
      sum(fi_count) AS cfs_count, sum(front_gross) AS base_gross, sum(interco_gross) AS interco_gross,
      sum(auction_gross) AS wholesale_gross, sum(front_revenue) AS retail_revenue, sum(interco_revenue) AS interco_revenue,
      sum(auction_revenue) AS wholesale_revenue, sum(fi_gross) AS cfs_gross, sum(ovi) AS ovi_gross,
      max(abs(vehicle_age_group)) AS ag, max(abs(vehicle_age)) AS sa, max(abs(cash_price)) AS p, max(abs(x.interco_revenue)) AS ic,
      max(abs(target_price)) AS tg, sum(front_cos) AS fc, max(abs(x.sold_count)) AS sc
      FROM (SELECT *, CASE WHEN left(source_name, 9) = 'From desk' THEN 'CAAD' ELSE source_type END AS code FROM sales_detail) x
      WHERE lower(department) = 'used' AND accounting_month = DATE '{_USED_MONTH}'
        AND region_name IN ('AFRICA','AMERICA','ASIA') AND record_source = 'Accounting'
      GROUP BY 1, 2, 3, 4, 5, 6, 7, 8
      HAVING sum(x.sold_count) <> 0 OR sum(front_gross) <> 0 OR sum(x.interco_gross) <> 0 OR sum(ovi) <> 0 OR sum(fi_gross) <> 0
        OR sum(auction_count) <> 0 OR sum(x.interco_count) <> 0 OR sum(auction_gross) <> 0) y""",
    ("sales_detail",),
)

# --- price history ----------------------------------------------------------------

_RUNS = """runs AS (SELECT *, row_number() OVER (PARTITION BY vin, store_name ORDER BY snapshot_date, event_id) AS appearance,
  row_number() OVER (PARTITION BY vin, store_name, internet_price ORDER BY snapshot_date, event_id) AS days_at_price,
  row_number() OVER (PARTITION BY vin, store_name, internet_price ORDER BY snapshot_date DESC, event_id DESC) AS from_last
  FROM inventory_daily WHERE snapshot_date >= DATE '2023-11-26' AND upper(status) = 'S' AND department = '320' AND internet_price IS NOT NULL)"""
_CHANGES = """kept AS (SELECT *, row_number() OVER (PARTITION BY vin, store_name ORDER BY snapshot_date, event_id) AS n FROM runs
    WHERE (days_at_price = 1 AND appearance <> 1) OR from_last = 1),
  busy AS (SELECT *, max(n) OVER (PARTITION BY vin) AS max_changes FROM kept)"""


def _runs(t):
    rows = t.inventory_daily.filter(
        D.last_days(F.col("snapshot_date"), 65, EVENT_AS_OF) & (F.upper("status") == "S") & (F.col("department") == "320")
        & F.col("internet_price").isNotNull()
    )
    return W.price_runs(rows, "vin", "store_name", "internet_price", "snapshot_date", ["event_id"])


register(
    "price_runs", "event_id:i vin store_name internet_price:d appearance:i days_at_price:i from_last:i price_change_flag:i",
    _runs, "SELECT *, CASE WHEN days_at_price = 1 THEN 1 ELSE 0 END AS price_change_flag FROM runs", ("inventory_daily",), _RUNS,
)
register(
    "price_changes", "event_id:i vin store_name snapshot_date:t internet_price:d days_at_price:i max_changes:i",
    lambda t: W.price_changes(_runs(t), "vin", "store_name"),
    "SELECT * FROM busy WHERE max_changes > 1", ("inventory_daily",), f"{_RUNS}, {_CHANGES}",
)
_BENCH = "target > 0 AND good_price IS NOT NULL AND good_price > 0"
register(
    "competitive_price_rank",
    "snapshot_date:t market_name store_name status vin year:i make model trim mileage:i original_source group_age:i store_days:i "
    "price:d cost:d price_adj:d cost_adj:d target:d benchmark_price:d price_rank days_at_price:i price_change_count:i count:i",
    lambda t: U.used_price_changes(t.inventory_daily, EVENT_AS_OF, ["event_id"]),
    f"""SELECT snapshot_date, market_name, store_name, status, vin, year, make, model, trim, mileage,
      {S.source_group('original_source_code', 'source_code')} AS original_source, days_in_inventory_group AS group_age,
      days_in_inventory AS store_days, internet_price AS price, balance AS cost,
      CASE WHEN {_BENCH} THEN internet_price ELSE 0 END AS price_adj, CASE WHEN {_BENCH} THEN balance ELSE 0 END AS cost_adj,
      CASE WHEN {_BENCH} THEN target ELSE 0 END AS target, CASE WHEN {_BENCH} THEN good_price ELSE 0 END AS benchmark_price,
      CASE WHEN internet_price >= poor_price + 0.01 THEN 'CG_Overpriced'
        WHEN internet_price BETWEEN fair_price + 0.01 AND poor_price THEN 'CG_High'
        WHEN internet_price BETWEEN good_price + 0.01 AND fair_price THEN 'CG_Fair'
        WHEN internet_price BETWEEN great_price + 0.01 AND good_price THEN 'CG_Good'
        WHEN internet_price <= great_price THEN 'CG_Great' ELSE 'CG_Unk' END AS price_rank,
      days_at_price, CASE WHEN days_at_price = 1 THEN 1 ELSE 0 END AS price_change_count, 1 AS count
    FROM (SELECT *, coalesce(target_price, 0) AS target FROM busy) b WHERE max_changes > 1 AND snapshot_date >= DATE '2024-01-16'""",
    ("inventory_daily",), f"{_RUNS}, {_CHANGES}",
)
register(
    "price_deltas", "event_id:i vin internet_price:d previous_price:d price_changed:b discount:d",
    lambda t: W.price_deltas(t.inventory_daily, "vin", "internet_price", "snapshot_date", ["event_id"]),
    """SELECT *, internet_price IS DISTINCT FROM previous_price AS price_changed,
      CASE WHEN internet_price IS DISTINCT FROM previous_price THEN previous_price - internet_price ELSE 0 END AS discount
    FROM (SELECT *, lag(internet_price) OVER (PARTITION BY vin ORDER BY snapshot_date, event_id) AS previous_price FROM inventory_daily) x""",
    ("inventory_daily",),
)
register(
    "latest_per_key", "vin snapshot_date:t event_id:i store_name internet_price:d",
    lambda t: W.latest_per(
        t.inventory_daily.select("vin", "snapshot_date", "event_id", "store_name", "internet_price"), ["vin"],
        ["snapshot_date", "event_id"],
    ),
    """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY vin ORDER BY snapshot_date DESC, event_id DESC) AS rn
      FROM inventory_daily) x WHERE rn = 1""", ("inventory_daily",),
)
register(
    "earliest_per_key", "vin store_id snapshot_date:t event_id:i target_price:d",
    lambda t: W.earliest_per(
        t.inventory_daily.filter("target_price IS NOT NULL").select("vin", "store_id", "snapshot_date", "event_id", "target_price"),
        ["vin", "store_id"], ["snapshot_date", "event_id"],
    ),
    """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY vin, store_id ORDER BY snapshot_date, event_id) AS rn
      FROM inventory_daily WHERE target_price IS NOT NULL) x WHERE rn = 1""", ("inventory_daily",),
)
register(
    "prefer_source_dedupe", "vin accounting_month:t store_name balance:d type_no:i",
    lambda t: W.prefer_source(
        t("inventory_month", "vin accounting_month store_name balance department").select(
            "vin", "accounting_month", "store_name", "balance", F.when(F.col("department") == "300", 1).otherwise(2).alias("type_no")
        ),
        "vin", ["type_no", "accounting_month", "store_name", "balance"],
    ),
    """SELECT * FROM (SELECT *, CASE WHEN vin IS NULL THEN 1 ELSE row_number() OVER (PARTITION BY vin ORDER BY type_no, accounting_month,
        store_name, balance NULLS FIRST) END AS rn
      FROM (SELECT *, CASE department WHEN '300' THEN 1 ELSE 2 END AS type_no FROM inventory_month) y) x WHERE rn = 1""",
    ("inventory_month",),
)
register(
    "first_target_price", "vin target_price:d original_acv:d balance:d",
    lambda t: U.first_target_price(t.inventory_daily, date(2024, 1, 2), EVENT_AS_OF, ["event_id"]),
    """SELECT DISTINCT vin, target_price, original_acv, balance FROM (SELECT *,
        row_number() OVER (PARTITION BY vin, store_id ORDER BY snapshot_date, event_id) AS rn FROM inventory_daily
      WHERE department = '320' AND snapshot_date BETWEEN DATE '2024-01-02' AND DATE '2024-01-30' AND upper(status) <> 'G'
        AND target_price IS NOT NULL AND target_price <> 0 AND balance >= original_acv) x WHERE rn = 1""", ("inventory_daily",),
)
_CARRY_BASE = """deltas AS (SELECT *, lag(internet_price) OVER (PARTITION BY vin ORDER BY snapshot_date, event_id) AS previous_price
    FROM busy WHERE max_changes > 1),
  walk AS (SELECT *, internet_price IS DISTINCT FROM previous_price AS changed,
      coalesce(internet_price IS DISTINCT FROM previous_price AND previous_price - internet_price <> 0, false) AS is_real FROM deltas),
  seg AS (SELECT *, coalesce(sum(CASE WHEN is_real THEN 1 ELSE 0 END) OVER (PARTITION BY vin ORDER BY days_at_price DESC, event_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM walk)"""


def _carry(t):
    changes = W.price_changes(_runs(t), "vin", "store_name")
    deltas = W.price_deltas(changes, "vin", "internet_price", "snapshot_date", ["event_id"])
    return W.carry_last_valid(
        deltas, "vin", "days_at_price", F.col("price_changed"), F.col("discount"), ["event_id"], "carried_days"
    )


register(
    "carry_last_valid", "event_id:i vin days_at_price:i carried_days:i",
    _carry,
    """SELECT event_id, vin, days_at_price, CASE WHEN is_real THEN coalesce(last_value(CASE WHEN changed AND NOT is_real THEN days_at_price END
        IGNORE NULLS) OVER (PARTITION BY vin, s ORDER BY days_at_price DESC, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
        days_at_price) ELSE days_at_price END AS carried_days FROM seg""",
    ("inventory_daily",), f"{_RUNS}, {_CHANGES}, {_CARRY_BASE}",
)

# --- buckets, strategy stack -------------------------------------------------------

register(
    "age_price_buckets", "accounting_month:t bucket_45 bucket_120 price_bucket inv_count:i",
    lambda t: U.used_inventory_buckets(t("inventory_month", "accounting_month region_name market_name balance inventory_count department status days_in_inventory_group price_tier_93"), THREE_BACK, R0, MARKETS),
    f"""SELECT accounting_month,
      CASE WHEN d IS NULL THEN 'N/A' WHEN d < 45 THEN 'Under 45 Days' ELSE 'Over/At 45 Days' END AS bucket_45,
      CASE WHEN d IS NULL THEN 'N/A' WHEN d < 120 THEN 'Under 120 Days' ELSE 'Over/At 120 Days' END AS bucket_120,
      CASE WHEN price_tier_93 IS NULL OR price_tier_93 < 1 THEN 'N/A' ELSE {S.price_open('price_tier_93')} END AS price_bucket,
      sum(inventory_count) AS inv_count
    FROM (SELECT *, days_in_inventory_group AS d FROM inventory_month) x
    WHERE accounting_month >= DATE '{THREE_BACK}' AND upper(region_name) <> '{R0}' AND upper(market_name) NOT IN ('NATION_3','NATION_7')
      AND balance > 0 AND inventory_count > 0 AND department = '320' AND upper(status) = 'S'
    GROUP BY ALL HAVING sum(inventory_count) <> 0""", ("inventory_month",),
)
register(
    "unit_bands", "age_bucket collapsed price_v1 price_v2 valid band units:i balance:d",
    lambda t: t("inventory_month", "days_in_inventory_group price_tier_93 balance target_price internet_price").groupBy(
        C.age_bucket(F.col("days_in_inventory_group")).alias("age_bucket"),
        C.collapse_age(C.age_bucket(F.col("days_in_inventory_group"))).alias("collapsed"),
        C.price_bucket_inclusive(F.col("price_tier_93"), F.col("balance")).alias("price_v1"),
        C.price_bucket_open(F.col("price_tier_93")).alias("price_v2"),
        C.valid_price(F.col("price_tier_93"), F.col("balance"), F.col("target_price")).alias("valid"),
        C.price_band(F.abs("internet_price"), F.abs("price_tier_93"), F.abs("balance")).alias("band"),
    ).agg(F.count(F.lit(1)).alias("units"), F.sum("balance").alias("balance")),
    f"""SELECT age_bucket, CASE WHEN age_bucket = 'N/A' THEN '01: 0-15' WHEN left(age_bucket, 3) IN ('06:','07:') THEN '06: >90'
      ELSE age_bucket END AS collapsed, price_v1, price_v2, valid, band, count(*) AS units, sum(balance) AS balance
    FROM (SELECT balance, {S.age_bucket('days_in_inventory_group')} AS age_bucket, {S.price_inclusive('price_tier_93', 'balance')} AS price_v1,
      {S.price_open('price_tier_93')} AS price_v2, {S.valid('price_tier_93', 'balance', 'target_price')} AS valid,
      {S.band('abs(internet_price)', 'abs(price_tier_93)', 'abs(balance)')} AS band FROM inventory_month) x GROUP BY ALL""",
    ("inventory_month",),
)
register(
    "source_group_coalesce", "source side short_side label units:i",
    lambda t: t("inventory_month", "original_source_code source_type").withColumn("source", C.source_group(F.col("original_source_code"), F.col("source_type")))
    .groupBy("source", C.source_side(F.col("source")).alias("side"), C.source_side_short(F.col("source")).alias("short_side"),
             C.source_label(F.col("source")).alias("label"))
    .agg(F.count(F.lit(1)).alias("units")),
    f"""SELECT source, CASE WHEN source IN ('AUCTION/RENTAL','Other') THEN 'Total: Ext. Sourced' ELSE 'Total: Int. Sourced' END AS side,
      CASE WHEN source IN ('AUCTION/RENTAL','Other') THEN 'External' ELSE 'Internal' END AS short_side,
      CASE source WHEN 'TRADE-IN' THEN 'Trade' WHEN 'AUCTION/RENTAL' THEN 'Auction' WHEN 'WBYC' THEN 'WBYC' ELSE 'Others' END AS label,
      count(*) AS units
    FROM (SELECT {S.source_group('original_source_code', 'source_type')} AS source FROM inventory_month) x GROUP BY ALL""",
    ("inventory_month",),
)
_START, _END = date(1998, 1, 1), CURRENT
_STRAT_ROWS = f"accounting_month BETWEEN DATE '{_START}' AND DATE '{_END}' AND upper(region_name) = 'ASIA'"
_STRAT_KEYS = """year(accounting_month) AS year, month(accounting_month) AS month, market_name,
   CASE WHEN left(store_name, 16) = 'Supplier#0000000' THEN 1 ELSE 0 END AS mt, store_id, store_name, vin"""
_SRC = S.source_group("original_source_code", "source_type")
register(
    "strategy_stack",
    "year:i month:i source source_group price_band age_bucket sold_count:i base_gross:d interco_gross:d cfs_gross:d ovi_gross:d "
    "cash_price:d target_price:d recon_cost:d inv_count:i inv_price:d inv_balance:d inv_target_price:d inv_over_45:i inv_over_120:i",
    lambda t: U.strategy_stack(t.inventory_month, t.sales_detail, _START, _END, "asia", ["NATION_6"], "Supplier#0000000"),
    f"""SELECT year, month, source, CASE WHEN source IN ('AUCTION/RENTAL','Other') THEN 'External' ELSE 'Internal' END AS source_group,
      price_band, age_bucket, sum(sold_count) AS sold_count, sum(base_gross) AS base_gross, sum(interco_gross) AS interco_gross,
      sum(cfs_gross) AS cfs_gross, sum(ovi_gross) AS ovi_gross, sum(cash_price) AS cash_price, sum(target_price) AS target_price,
      sum(recon_cost) AS recon_cost, sum(inv_count) AS inv_count, sum(inv_price) AS inv_price, sum(inv_balance) AS inv_balance,
      sum(inv_target_price) AS inv_target_price, sum(inv_over_45) AS inv_over_45, sum(inv_over_120) AS inv_over_120
    FROM (SELECT year, month, source, {S.band('p', 'ic')} AS price_band, {S.age_band('ag')} AS age_bucket, sold_count, base_gross, interco_gross, cfs_gross, ovi_gross,
        {S.gate('p', 'sold_count', 'p', 'tg')} AS cash_price, {S.gate('tg', 'sold_count', 'p', 'tg')} AS target_price, recon_cost,
        0 AS inv_count, 0 AS inv_price, 0 AS inv_balance, 0 AS inv_target_price, 0 AS inv_over_45, 0 AS inv_over_120
      FROM (SELECT {_STRAT_KEYS}, {_SRC} AS source, sum(sold_count) AS sold_count, sum(front_gross) AS base_gross,
          sum(interco_gross) AS interco_gross, sum(fi_gross) AS cfs_gross, sum(ovi) AS ovi_gross,
          sum(CASE WHEN recon_cost IS NULL OR x.sold_count <> 1 THEN 0 ELSE recon_cost END)
            + sum(CASE WHEN non_ro_amount IS NULL OR x.sold_count <> 1 THEN 0 ELSE non_ro_amount END) AS recon_cost,
          max(abs(vehicle_age_group)) AS ag, max(abs(front_revenue)) AS p, max(abs(interco_revenue)) AS ic, max(abs(target_price)) AS tg
        FROM sales_detail x WHERE {_STRAT_ROWS} AND upper(department) = 'USED' AND record_source = 'Accounting'
        GROUP BY 1, 2, 3, 4, 5, 6, 7, 8
        HAVING sum(x.sold_count) <> 0 OR sum(front_gross) <> 0 OR sum(fi_gross) <> 0 OR sum(x.interco_gross) <> 0 OR sum(ovi) <> 0) s
      UNION ALL
      SELECT year, month, source, {S.band('p', 'w', 'bal')}, {S.age_band('ag')}, 0, 0, 0, 0, 0, 0, 0, 0, inv_count,
        {S.gate('p', 'inv_count', 'p', 'tg', 'bal')}, {S.gate('bal', 'inv_count', 'p', 'tg', 'bal')},
        {S.gate('tg', 'inv_count', 'p', 'tg', 'bal')}, CASE WHEN ag > 45 THEN inv_count ELSE 0 END, CASE WHEN ag > 120 THEN inv_count ELSE 0 END
      FROM (SELECT {_STRAT_KEYS}, {_SRC} AS source, sum(inventory_count) AS inv_count, max(abs(days_in_inventory_group)) AS ag,
          max(abs(internet_price)) AS p, max(abs(price_tier_93)) AS w, max(abs(balance)) AS bal, max(abs(target_price)) AS tg
        FROM inventory_month WHERE {_STRAT_ROWS} AND department = '320' AND upper(status) = 'S' AND market_name <> 'NATION_6'
        GROUP BY 1, 2, 3, 4, 5, 6, 7, 8 HAVING sum(inventory_count) <> 0) i) u
    GROUP BY ALL""", _PAIR,
)
_ROWS = f"accounting_month BETWEEN DATE '{_START}' AND DATE '{_END}' AND upper(region_name) = 'ASIA'"
register(
    "trades_by_month", "month:i year:i vehicle_sold:i trades:i",
    lambda t: U.sold_and_trades(t("sales_detail", "accounting_month region_name record_source trade_vin sold_count"), _START, _END, "asia"),
    f"""SELECT month, year, sum(v) AS vehicle_sold, sum(tr) AS trades FROM (SELECT month(accounting_month) AS month,
        year(accounting_month) AS year, sum(sold_count) AS v, CASE WHEN trade_vin IS NOT NULL THEN sum(sold_count) ELSE 0 END AS tr
      FROM sales_detail WHERE {_ROWS} AND record_source = 'Accounting' GROUP BY 1, 2, trade_vin HAVING sum(sold_count) <> 0) x
    GROUP BY ALL""", ("sales_detail",),
)
register(
    "wholesale_by_month", "month:i year:i wholesale_sold:i",
    lambda t: U.wholesale(t("sales_detail", "accounting_month region_name department auction_count"), _START, _END, "asia"),
    f"""SELECT month(accounting_month) AS month, year(accounting_month) AS year, sum(auction_count) AS wholesale_sold
    FROM sales_detail WHERE {_ROWS} AND upper(department) = 'USED' GROUP BY 1, 2 HAVING sum(auction_count) <> 0""", ("sales_detail",),
)

# --- single rules on whole tables ----------------------------------------------------

register(
    "price_band_fallback", "band units:i balance:d",
    lambda t: t("inventory_month", "internet_price price_tier_93 balance").groupBy(
        C.price_band(F.abs("internet_price"), F.abs("price_tier_93"), F.abs("balance")).alias("band")
    ).agg(F.count(F.lit(1)).alias("units"), F.sum("balance").alias("balance")),
    f"""SELECT {S.band('abs(internet_price)', 'abs(price_tier_93)', 'abs(balance)')} AS band, count(*) AS units, sum(balance) AS balance
    FROM inventory_month GROUP BY 1""", ("inventory_month",),
)
register(
    "valid_price_gate", "make valid units:i",
    lambda t: t("inventory_month", "make price_tier_93 balance target_price").groupBy(
        "make", C.valid_price(F.col("price_tier_93"), F.col("balance"), F.col("target_price")).alias("valid")
    ).agg(F.count(F.lit(1)).alias("units")),
    f"SELECT make, {S.valid('price_tier_93', 'balance', 'target_price')} AS valid, count(*) AS units FROM inventory_month GROUP BY 1, 2",
    ("inventory_month",),
)
_GATE = ("sold_count", "cash_price", "target_price", "front_cos")


def _gated(t):
    rows = t("sales_detail", "store_id sold_count cash_price target_price front_cos")
    ok = C.price_gate(*[F.col(c) for c in _GATE])
    return rows.withColumn("ok", ok).groupBy("store_id").agg(
        *[F.sum(C.gated(F.col("ok"), F.col(c))).alias(c) for c in _GATE]
    )


register(
    "gated_measures", "store_id sold_count:i cash_price:d target_price:d front_cos:d", _gated,
    "SELECT store_id, " + ", ".join(f"sum({S.gate('s.' + c, 's.sold_count', 's.cash_price', 's.target_price', 's.front_cos')}) AS {c}" for c in _GATE)
    + " FROM sales_detail s GROUP BY 1", ("sales_detail",),
)
register(
    "sale_sources", "source units:i gross:d",
    lambda t: t("sales_detail", "source_name source_type sold_count front_gross").groupBy(
        C.sale_source(F.col("source_name"), F.col("source_type")).alias("source")
    ).agg(F.sum("sold_count").alias("units"), F.sum("front_gross").alias("gross")),
    """SELECT CASE WHEN left(source_name, 9) = 'From desk' THEN 'Auction' ELSE CASE lower(source_type) WHEN 'activeloaner' THEN 'ExLoaner'
      WHEN 'auction' THEN 'Auction' WHEN 'dealer-trade' THEN 'Trade' WHEN 'inter-co' THEN 'Interco' WHEN 'webuyyourcar' THEN 'WBYC' ELSE 'Other' END END AS source,
      sum(sold_count) AS units, sum(front_gross) AS gross FROM sales_detail GROUP BY 1""", ("sales_detail",),
)
_LAST_MONDAY, _LAST_SUNDAY = D.last_week(EVENT_AS_OF)
register(
    "last_week_snapshots", "store_name snapshot_date:t units:i price:d",
    lambda t: t("inventory_daily", "store_name snapshot_date internet_price").filter(
        D.between_days(F.col("snapshot_date"), _LAST_MONDAY, _LAST_SUNDAY)
    ).groupBy("store_name", "snapshot_date").agg(F.count(F.lit(1)).alias("units"), F.sum("internet_price").alias("price")),
    """SELECT store_name, snapshot_date, count(*) AS units, sum(internet_price) AS price FROM inventory_daily
    WHERE snapshot_date BETWEEN DATE '2024-01-22' AND DATE '2024-01-28' GROUP BY 1, 2""", ("inventory_daily",),
)
