"""Market-share cubes and the industry file on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotwise.functions import classify as C
from lotwise.operators import lookup as LK
from lotwise.operators import measures as MS
from lotwise.operators.windows import flag_latest
from lotwise.plans import market_share as MK
from lotwise.session import written

from . import rules_sql as S
from .base import register
from .roles import DERIVED, MARKET_AS_OF

ROLES = ("sales_current", "sales_history", "allowed_pairs")
_BRANDS = {
    "CHRYSLER": "Chrysler", "DODGE": "Chrysler", "JEEP": "Chrysler", "RAM": "Chrysler", "FORD": "Ford", "LINCOLN": "Ford",
    "BUICK": "GM", "CADILLAC": "GM", "CHEVROLET": "GM", "GMC": "GM", "HYUNDAI": "Hyundai", "GENESIS": "Hyundai",
    "JAGUAR": "Jaguar Land Rover", "LAND ROVER": "Jaguar Land Rover", "ACURA": "Acura", "HONDA": "Honda", "TOYOTA": "Toyota",
    "AUDI": "Audi", "BMW": "BMW", "LEXUS": "Lexus", "MERCEDES-BENZ": "Mercedes", "MINI": "MINI",
}
_BRAND_SQL = "CASE make " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _BRANDS.items()) + " END"


def _dims(t, allowed=None):
    brand = t.vehicles.select(F.col("brand_code").alias("make")).distinct().filter("make IS NOT NULL")
    return {
        "allowed": t.allowed_pairs if allowed is None else allowed,
        "market": t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
            F.col("n_name").alias("market_name"), F.col("r_name").alias("group_market")
        ),
        "brand": brand.select("make", C.map_values(F.col("make"), _BRANDS).alias("brand_group")),
        "override": t.supplier.select(
            F.col("s_suppkey").cast("string").alias("site_code"),
            F.when(F.col("s_acctbal") > 5000, F.concat(F.lit("OV"), F.col("s_suppkey").cast("string"))).alias("own_store_override"),
            F.concat(F.lit("Override "), F.col("s_suppkey").cast("string")).alias("selling_dealer_override"),
        ),
    }


def _prepared(t):
    """Current and historical sales and the allowed pairs are selections of one table of sales, which is joined and stored once."""
    sales = written(t.market_sales, "market-sales")
    part = lambda role: sales.filter(DERIVED[role][2])
    pairs = part("allowed_pairs").select(*DERIVED["allowed_pairs"][1]).distinct()
    return MK.prepare_sales(part("sales_current"), part("sales_history"), _dims(t, pairs), MARKET_AS_OF)


_PREPARED = f"""prepared AS (SELECT c.market_name, c.make, CASE WHEN own_store = '' THEN CASE WHEN s_acctbal > 5000 THEN 'OV' || site_code END ELSE own_store END AS own_store,
    CASE WHEN selling_dealer = '' THEN 'Override ' || site_code ELSE selling_dealer END AS selling_dealer, sale_year, sale_month, mtd_sales,
    r_name AS group_market, brand_group, {S.brand_segment('brand_group')} AS segment, c.make || c.market_name AS make_market
  FROM (SELECT *, {_BRAND_SQL} AS brand_group FROM (SELECT * FROM sales_current WHERE NOT (sale_year = 1999 AND sale_month IN (6, 7))
      UNION ALL SELECT * FROM sales_history) u) c
  JOIN allowed_pairs a ON a.market_name = c.market_name AND a.make = c.make
  LEFT JOIN nation ON n_name = c.market_name LEFT JOIN region ON r_regionkey = n_regionkey
  LEFT JOIN supplier ON CAST(s_suppkey AS VARCHAR) = c.site_code)"""
_OUT = "store_num selling_dealer brand_group group_market market_name segment"
_KEYS = "store_num, selling_dealer, group_market, brand_group, segment, make_market, market_name"
register(
    "market_share_monthly", f"{_OUT} share_pct:r time:i year:i make_market_sales:i mtd_sales:i comp_sales:i own_sales:i",
    lambda t: MK.monthly_cube(_prepared(t)),
    f"""SELECT CASE WHEN store_num = 'Competition' THEN '' ELSE store_num END AS store_num, selling_dealer, brand_group, group_market, market_name, segment,
      round_even(CAST(s AS DOUBLE) / CAST(total AS DOUBLE), 3) AS share_pct, sale_month AS time, sale_year AS year, total AS make_market_sales, s AS mtd_sales,
      CASE WHEN store_num = 'Competition' THEN s ELSE 0 END AS comp_sales, CASE WHEN store_num = 'Competition' THEN 0 ELSE s END AS own_sales
    FROM (SELECT *, sum(s) OVER (PARTITION BY make_market, sale_month, sale_year) AS total FROM (
      SELECT coalesce(own_store, 'Competition') AS store_num, selling_dealer, group_market, brand_group, segment, make_market, market_name, sale_month,
        sale_year, sum(mtd_sales) AS s FROM prepared GROUP BY ALL) m) x""", ROLES, _PREPARED,
)
_MONTHS = "('YTDJan', 1), ('YTDFeb', 2), ('YTDMar', 3), ('YTDApr', 4), ('YTDMay', 5), ('YTDJun', 6), ('YTDJul', 7), ('YTDAug', 8)"
register(
    "market_share_ytd", f"{_OUT} share_pct:r time year:i make_market_sales:i ytd_sales:i comp_sales:i own_sales:i",
    lambda t: MK.ytd_cube(_prepared(t), MARKET_AS_OF),
    f"""SELECT store_num, selling_dealer, brand_group, group_market, market_name, segment, round_even(CAST(s AS DOUBLE) / CAST(total AS DOUBLE), 3) AS share_pct,
      time, sale_year AS year, total AS make_market_sales, s AS ytd_sales, CASE WHEN store_num = 'Competition' THEN s ELSE 0 END AS comp_sales,
      CASE WHEN store_num = 'Competition' THEN 0 ELSE s END AS own_sales
    FROM (SELECT *, sum(s) OVER (PARTITION BY make_market, sale_year, time) AS total FROM (
      SELECT {_KEYS}, sale_year, m.time, sum(mtd_sales) AS s FROM (SELECT *, coalesce(nullif(own_store, ''), 'Competition') AS store_num FROM prepared) p
      JOIN (VALUES {_MONTHS}) m(time, n) ON p.sale_month <= m.n GROUP BY ALL) y) x""", ROLES, _PREPARED,
)
register(
    "share_of_total", "market_name make units:i total:i share:r",
    lambda t: MS.share_of_total(
        t("market_sales", "market_name make mtd_sales").groupBy("market_name", "make").agg(F.sum("mtd_sales").alias("units")), ["make"], "units", "total", "share", None
    ),
    """SELECT market_name, make, units, total, CAST(units AS DOUBLE) / CAST(total AS DOUBLE) AS share FROM (SELECT *, sum(units) OVER (PARTITION BY make) AS total
      FROM (SELECT market_name, make, sum(mtd_sales) AS units FROM market_sales GROUP BY 1, 2) a) b""", ("market_sales",),
)
register(
    "tag_competition", "store_num historical comp_sales:i own_sales:i",
    lambda t: t("market_sales", "own_store mtd_sales").select(
        C.store_or_competition(F.col("own_store"), True).alias("store_num"), C.store_or_competition(F.col("own_store"), False).alias("historical"),
        *[c.alias(n) for c, n in zip(C.split_measure(C.store_or_competition(F.col("own_store"), True), F.col("mtd_sales")), ("comp", "own"))],
    ).groupBy("store_num", "historical").agg(F.sum("comp").alias("comp_sales"), F.sum("own").alias("own_sales")),
    """SELECT CASE WHEN own_store IS NULL OR own_store = '' THEN 'Competition' ELSE own_store END AS store_num, coalesce(own_store, 'Competition') AS historical,
      sum(CASE WHEN own_store IS NULL OR own_store = '' THEN mtd_sales ELSE 0 END) AS comp_sales,
      sum(CASE WHEN own_store <> '' THEN mtd_sales ELSE 0 END) AS own_sales FROM market_sales GROUP BY 1, 2""", ("market_sales",),
)
register(
    "blank_override", "site_code own_store selling_dealer units:i",
    lambda t: LK.override_blank(
        t("market_sales", "site_code own_store selling_dealer mtd_sales").groupBy("site_code", "own_store", "selling_dealer").agg(F.sum("mtd_sales").alias("units")), _dims(t)["override"],
        ["site_code"], {"own_store": "own_store_override", "selling_dealer": "selling_dealer_override"},
    ).groupBy("site_code", "own_store", "selling_dealer").agg(F.sum("units").alias("units")),
    """SELECT site_code, CASE WHEN own_store = '' THEN CASE WHEN s_acctbal > 5000 THEN 'OV' || site_code END ELSE own_store END AS own_store,
      CASE WHEN selling_dealer = '' THEN 'Override ' || site_code ELSE selling_dealer END AS selling_dealer, sum(mtd_sales) AS units
    FROM market_sales JOIN supplier ON CAST(s_suppkey AS VARCHAR) = site_code GROUP BY 1, 2, 3""", ("market_sales",),
)
register(
    "allowed_whitelist_join", "market_name make units:i",
    lambda t: LK.restrict_to_allowed(t("market_sales", "market_name make mtd_sales"), t.allowed_pairs, ["market_name", "make"]).groupBy("market_name", "make").agg(
        F.sum("mtd_sales").alias("units")
    ),
    """SELECT m.market_name, m.make, sum(mtd_sales) AS units FROM market_sales m JOIN allowed_pairs a ON a.market_name = m.market_name AND a.make = m.make
    GROUP BY 1, 2""", ("market_sales", "allowed_pairs"),
)
_INDUSTRY_BRAND = ("CASE WHEN make IN ('CHRY','DODG','JEEP','RAM') THEN 'Chrysler' WHEN make IN ('FORD','LINC') THEN 'Ford' "
                   "WHEN make IN ('BUIC','CADI','CHEV','GMCT') THEN 'GM' WHEN make IN ('HYUN','GEN') THEN 'Hyundai' "
                   "WHEN make IN ('JAG','ROV') THEN 'Jaguar Land Rover' WHEN make = 'MB' THEN 'Mercedes' WHEN make = 'LEX' THEN 'Lexus' "
                   "WHEN make = 'ACUR' THEN 'Acura' WHEN make = 'HOND' THEN 'Honda' WHEN make = 'TOY' THEN 'Toyota' WHEN make = 'AUDI' THEN 'Audi' "
                   "WHEN make = 'FIAT' THEN 'Fiat' WHEN make = 'KIA' THEN 'Kia' WHEN make IN ('BMW','MINI') THEN make ELSE 'Unknown' END")


def _industry(t):
    return t.industry.groupBy("make", "sale_year", "sale_month", "file_date").agg(F.sum("sales").alias("sales"))


register(
    "industry_tags", "make sale_year:i sale_month:i file_date:t sales:i brand segment is_max_date:i is_current_month:i",
    lambda t: MK.tag_industry(_industry(t), MARKET_AS_OF),
    f"""SELECT *, {S.brand_segment('brand')} AS segment, CASE WHEN file_date = (SELECT max(file_date) FROM ind) THEN 1 ELSE 0 END AS is_max_date,
      CASE WHEN sale_year IN (2000, 1999) AND sale_month = 8 THEN 1 ELSE 0 END AS is_current_month
    FROM (SELECT *, {_INDUSTRY_BRAND} AS brand FROM ind) x""", ("industry",),
    "ind AS (SELECT make, sale_year, sale_month, file_date, sum(sales) AS sales FROM industry GROUP BY 1, 2, 3, 4)",
)
register(
    "latest_flag", "event_type snapshot_date:t is_max_date:i events:i",
    lambda t: flag_latest(
        t.inventory_daily.groupBy(F.col("store_name").alias("event_type"), "snapshot_date").agg(F.count(F.lit(1)).alias("events")), "snapshot_date",
        "is_max_date",
    ),
    """SELECT store_name AS event_type, snapshot_date, CASE WHEN snapshot_date = (SELECT max(snapshot_date) FROM inventory_daily) THEN 1 ELSE 0 END AS is_max_date,
      count(*) AS events FROM inventory_daily GROUP BY 1, 2""", ("inventory_daily",),
)
