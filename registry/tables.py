"""Lookup, rule, history, file, extraction and question operators on the driver's tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from lotwise.functions import classify as C
from lotwise.functions import dates as D
from lotwise.functions import text as TX
from lotwise.operators import extract as X
from lotwise.operators import history as H
from lotwise.operators import lookup as LK
from lotwise.operators import matching as MA
from lotwise.operators import measures as MS
from lotwise.operators import questions as Q
from lotwise.operators import rules as RU
from lotwise.operators import stacking as ST
from lotwise.operators import tags as TG
from lotwise.operators.predicates import drop_overlap, exclude_values
from lotwise.plans import allocation_groups as AG
from lotwise.plans import upkeep as K
from lotwise.session import new_path, written
from lotwise.sources import files as FS
from lotwise.sources import ledger as LG
from lotwise.sources import sinks as SK
from lotwise.streaming.ingest import ingest_new_files

from . import model_lines as ML
from . import rules_sql as S
from .base import register
from .roles import AS_OF, MARKET_AS_OF

# --- lookups and rules ------------------------------------------------------------------

register(
    "dict_map_last_wins", "p_type p_size:i last_name last_price:d parts:i",
    lambda t: LK.lookup(
        t.part.groupBy("p_type", "p_size").agg(F.count(F.lit(1)).alias("parts")),
        LK.dedupe_last(t.part.select("p_type", "p_partkey", "p_name", "p_retailprice"), ["p_type"], ["p_partkey"]),
        ["p_type"], {"p_name": "last_name", "p_retailprice": "last_price"},
    ),
    """SELECT p_type, p_size, count(*) AS parts, any_value(l.p_name) AS last_name, any_value(l.p_retailprice) AS last_price FROM part p
    JOIN (SELECT p_type AS ty, p_name, p_retailprice, row_number() OVER (PARTITION BY p_type ORDER BY p_partkey DESC) AS rn FROM part) l
      ON l.ty = p.p_type AND rn = 1 GROUP BY 1, 2""",
)
register(
    "map_values_default", "make_code brand segment units:i",
    lambda t: t("industry", "make sales").groupBy(
        F.col("make").alias("make_code"), C.industry_brand(F.col("make")).alias("brand"),
        C.brand_segment(C.industry_brand(F.col("make"))).alias("segment"),
    ).agg(F.sum("sales").alias("units")),
    f"""SELECT make AS make_code, brand, {S.brand_segment('brand')} AS segment, sum(sales) AS units FROM (SELECT *, CASE
      WHEN make IN ('CHRY','DODG','JEEP','RAM') THEN 'Chrysler' WHEN make IN ('FORD','LINC') THEN 'Ford'
      WHEN make IN ('BUIC','CADI','CHEV','GMCT') THEN 'GM' WHEN make IN ('HYUN','GEN') THEN 'Hyundai' WHEN make IN ('JAG','ROV') THEN 'Jaguar Land Rover'
      WHEN make = 'MB' THEN 'Mercedes' WHEN make IN ('BMW','MINI') THEN make WHEN make = 'XXXX' THEN 'Unknown'
      ELSE list_value('Fiat','Acura','Honda','Toyota','Audi','Lexus','Kia')[list_position(list_value('FIAT','ACUR','HOND','TOY','AUDI','LEX','KIA'), make)] END AS brand
      FROM industry) x GROUP BY 1, 2, 3""", ("industry",),
)
register(
    "exclude_values", "make model units:i",
    lambda t: exclude_values(t("sales_detail", "make model sold_count"), {"make": ["FIAT", "KIA"], "model": ["PROMO"]}).groupBy("make", "model").agg(
        F.sum("sold_count").alias("units")
    ),
    """SELECT make, model, sum(sold_count) AS units FROM sales_detail WHERE (make IS NULL OR make NOT IN ('FIAT','KIA')) AND model <> 'PROMO'
    GROUP BY 1, 2""", ("sales_detail",),
)

# Models for the allocation mapping: part names dressed up as real model lines.
_LINES = ["SILVERADO 2500HD", "SIERRA 1500", "TRANSIT CARGO", "TUNDRA", "WRANGLER", "ESCALADE ESV", "YUKON XL", "1500", "SPRINTER VAN", "RX", "GRAND CHEROKEE"]
_CABS = ["CREW CAB", "DOUBLE CAB 4WD", "REG", "RX 350 4 DOOR", "2DR SAHARA", "500 IS", "BASE TRIM LEVEL"]


def _models(t):
    pick = lambda values, index: F.element_at(F.array(*[F.lit(v) for v in values]), index)
    number = F.regexp_replace("brand_id", "Brand#", "").cast("int")
    return t.vehicles.select(
        F.col("dealer_vehicle_id").alias("style_id"), F.col("brand_code").alias("make"),
        pick(_LINES, (F.col("dealer_vehicle_id") % 11 + 1).cast("int")).alias("model"),
        F.concat(F.lit("M"), (F.col("dealer_vehicle_id") % 40).cast("string")).alias("model_id"),
        F.concat(pick(_CABS, (F.col("dealer_vehicle_id") % 7 + 1).cast("int")), F.lit(" "), number.cast("string")).alias("style_name"),
        F.when(F.col("dealer_vehicle_id") % 3 == 0, "Sport").otherwise("Base").alias("trim"),
    ).filter("make IS NOT NULL")


def _groups(t):
    pairs = t.vehicles.select("brand_code", "dealer_vehicle_id").filter("brand_code IS NOT NULL")
    model = F.element_at(F.array(*[F.lit(v) for v in _LINES]), (F.col("dealer_vehicle_id") % 11 + 1).cast("int"))
    entries = pairs.select(
        F.concat(F.col("dealer_vehicle_id").cast("string"), F.lit(" {"), "brand_code", F.lit("_"), model, F.lit("}")).alias("entry"),
        F.col("dealer_vehicle_id").alias("position"),
    )
    return AG.group_table(entries, "entry", "position")


def _vans(t):
    return t.vehicles.select(
        F.concat(F.lit("M"), (F.col("dealer_vehicle_id") % 20).cast("string")).alias("model_id"),
        F.concat(F.lit("VAN"), (F.col("dealer_vehicle_id") % 20).cast("string")).alias("group_code"),
    ).distinct()


_RULE_ROLES = ("vehicles",)
_LINE_LIST = ", ".join(f"'{x}'" for x in _LINES)
_CAB_LIST = ", ".join(f"'{x}'" for x in _CABS)
_RULE_SQL = f"""raw AS (SELECT dealer_vehicle_id AS style_id, brand_code AS make, list_value({_LINE_LIST})[CAST(dealer_vehicle_id % 11 + 1 AS INT)] AS model,
    'M' || (dealer_vehicle_id % 40) AS model_id,
    list_value({_CAB_LIST})[CAST(dealer_vehicle_id % 7 + 1 AS INT)] || ' ' || replace(brand_id, 'Brand#', '') AS style_name,
    CASE WHEN dealer_vehicle_id % 3 = 0 THEN 'Sport' ELSE 'Base' END AS trim FROM vehicles WHERE brand_code IS NOT NULL),
 grp AS (SELECT group_key, arg_max(entry, pos) AS g FROM (SELECT upper(make || '_' || model) AS group_key,
    style_id || ' {{' || make || '_' || model || '}}' AS entry, style_id AS pos FROM raw) e GROUP BY 1),
 van AS (SELECT DISTINCT 'M' || (dealer_vehicle_id % 20) AS model_id, 'VAN' || (dealer_vehicle_id % 20) AS group_code FROM vehicles),
 keyed AS (SELECT *, CASE WHEN make = 'MERCEDES-BENZ' THEN make || '_' || model_id
    WHEN make = 'LEXUS' THEN make || '_' || CASE WHEN style_name LIKE '%450%' THEN model || ' 450H' WHEN style_name LIKE '%350%' THEN model || ' 350H'
      WHEN style_name LIKE '%500%' AND style_name LIKE '%IS%' THEN model || ' 500' WHEN style_name LIKE '%500%' THEN model || '500'
      WHEN style_name LIKE '%550%' THEN model || ' 550H' WHEN style_name LIKE '%RX%' THEN model
      ELSE split_part(style_name, ' ', 1) || ' ' || split_part(style_name, ' ', 2) END
    ELSE make || '_' || CASE WHEN make = 'CADILLAC' AND model LIKE '%ESCALADE%' THEN 'ESC' WHEN make = 'FORD' AND model LIKE '%TRANSIT%' THEN 'TRANSIT'
      WHEN make = 'GMC' AND model = 'YUKON XL' THEN 'YKNXL' WHEN model = 'ESCALADE ESV' THEN 'ESCESV' ELSE model END END AS k,
  CASE WHEN make = 'CHEVROLET' AND model = 'SILVERADO 2500HD' THEN CASE WHEN style_name LIKE '%CREW CAB%' THEN '1466 {{Chevrolet_CHDCRW}}'
      WHEN style_name LIKE '%DOUBLE CAB%' THEN '2558 {{Chevrolet_CHDDBL}}' WHEN style_name LIKE '%REG%' THEN '1467 {{Chevrolet_CHDREG}}' END
    WHEN make = 'GMC' AND model = 'SIERRA 1500' THEN CASE WHEN style_name LIKE '%CREW CAB%' THEN '1763 {{GMC_GLDCRW}}'
      WHEN style_name LIKE '%DOUBLE CAB%' THEN '1764 {{GMC_GLDDBL}}' WHEN style_name LIKE '%REG%' THEN '1765 {{GMC_GLDREG}}' END
    WHEN make = 'TOYOTA' AND model = 'TUNDRA' THEN CASE WHEN style_name LIKE '%4WD%' THEN '2487 {{Toyota_TUNDRA 4WD}}' ELSE '2488 {{Toyota_TUNDRA 2WD}}' END
    WHEN make = 'RAM' AND model LIKE '%1500%' THEN '2361 {{Ram_CREWPRM}}' WHEN make = 'RAM' AND model LIKE '%2500%' THEN '2364 {{RAM_HD 2500}}' END AS special,
  CASE WHEN make = 'JEEP' THEN 'JEEP_' || CASE WHEN model = 'WRANGLER' THEN CASE WHEN trim = 'Sport' THEN 'WRNGLR SPR'
      WHEN style_name LIKE '%2DR%' THEN '2DR WRANGL' WHEN style_name LIKE '%4 DOOR%' THEN '4DR WRANGL' ELSE 'WRANGL' END ELSE model END END AS jk FROM raw)"""
register(
    "rule_table_mapping", "style_id:i make model model_id style_name trim allocation_group",
    lambda t: AG.assign_allocation_group(_models(t), _groups(t), _vans(t)),
    """SELECT style_id, make, model, x.model_id, style_name, trim, coalesce(CASE WHEN make = 'MERCEDES-BENZ' AND model LIKE '%SPRINTER%' THEN v.group_code
      ELSE coalesce(special, a.g, b.g) END, 'nomap') AS allocation_group
    FROM keyed x LEFT JOIN grp a ON a.group_key = x.k LEFT JOIN grp b ON b.group_key = x.jk LEFT JOIN van v ON v.model_id = x.model_id""",
    _RULE_ROLES, _RULE_SQL,
)


def _line_groups(t):
    """The group list: entries of the lines' keys and, for pipeline models, of keys made of a make and a group."""
    line = ML.line_of(F.col("dealer_vehicle_id"))
    keys = t.vehicles.select("dealer_vehicle_id", "brand_model_code", line.alias("line"))
    keys = keys.select("*", F.explode(ML.listed(F.col("line"), F.col("dealer_vehicle_id"))).alias("key")).select("dealer_vehicle_id", "key").unionByName(
        keys.select("dealer_vehicle_id", F.concat("line.make", F.lit("_"), "brand_model_code", F.lit("-"), (F.col("dealer_vehicle_id") % 50 + 1).cast("string")).alias("key"))
    )
    entries = keys.select(F.concat(F.col("dealer_vehicle_id").cast("string"), F.lit(" {"), "key", F.lit("}")).alias("entry"), F.col("dealer_vehicle_id").alias("position"))
    return AG.group_table(entries, "entry", "position")


def _with_line(df, number):
    """``df`` with the make, model, style, trim and id of the line that a number column stands for."""
    line = ML.line_of(F.col(number))
    return df.withColumns({c: line[c] for c in ("make", "model", "style_name", "trim", "model_id")})


_LINE_GROUPS = f"""{ML.LINES_SQL}, {ML.LISTED_SQL},
  numbered AS (SELECT *, dealer_vehicle_id % {len(ML.LINES)} AS line FROM vehicles),
  entries AS (SELECT dealer_vehicle_id AS n, listed_key AS k FROM numbered JOIN listed USING (line)
    UNION ALL SELECT dealer_vehicle_id, l.make || '_' || brand_model_code || '-' || (dealer_vehicle_id % 50 + 1) FROM numbered JOIN lines l USING (line)),
  grp AS (SELECT upper(k) AS k, arg_max(n || ' {{' || k || '}}', n) AS g FROM entries GROUP BY 1),
  van AS (SELECT DISTINCT 'M' || (dealer_vehicle_id % 20) AS model_id, 'VAN' || (dealer_vehicle_id % 20) AS v FROM vehicles),
  mapped AS (SELECT l.*, CASE WHEN l.make = 'Mercedes-Benz' AND l.model LIKE 'Sprinter%' THEN v ELSE coalesce(special, a.g, b.g) END AS in_stock,
      CASE WHEN l.make = 'Mercedes-Benz' AND l.model LIKE 'Sprinter%' THEN v ELSE coalesce(c.g, d.g) END AS on_order
    FROM lines l LEFT JOIN grp a ON a.k = l.key LEFT JOIN grp b ON b.k = l.second_key LEFT JOIN grp c ON c.k = l.plain_key LEFT JOIN grp d ON d.k = l.plain_second_key
      LEFT JOIN van ON van.model_id = l.model_id
    WHERE l.make <> 'Maserati' AND l.model <> 'Police Interceptor Utility')"""
register(
    "every_rule_mapping", "style_id:i make model model_id style_name trim allocation_group",
    lambda t: AG.assign_allocation_group(_with_line(t.vehicles.select(F.col("dealer_vehicle_id").alias("style_id")), "style_id"), _line_groups(t), _vans(t)),
    f"""SELECT dealer_vehicle_id AS style_id, m.make, m.model, m.model_id, m.style_name, m.trim, coalesce(in_stock, 'nomap') AS allocation_group
    FROM vehicles JOIN mapped m ON m.line = dealer_vehicle_id % {len(ML.LINES)}""", ("vehicles",), _LINE_GROUPS,
)


def _rule_report(t):
    models = _with_line(t.vehicles.select(F.col("dealer_vehicle_id").alias("style_id")), "style_id").withColumnRenamed("style_name", "style")
    reports = [
        RU.rule_report(models, rules, ["make", "model", "style"]).withColumn("list", F.lit(name))
        for name, rules in (("abbreviation", AG.MODEL_ABBREVIATIONS), ("special", AG.SPECIAL_GROUPS))
    ]
    return ST.stack_facts(reports)


register(
    "rule_report", "list priority:i result won:i", _rule_report,
    f"""SELECT 'abbreviation' AS list, line AS priority, split_part(key, '_', 2) AS result, n AS won FROM lines JOIN counts USING (line) WHERE line < {ML.ABBREVIATED}
    UNION ALL SELECT 'special', line - {ML.ABBREVIATED}, special, n FROM lines JOIN counts USING (line) WHERE line BETWEEN {ML.ABBREVIATED} AND {ML.ABBREVIATED + ML.SPECIAL - 1}""",
    ("vehicles",), f"{ML.LINES_SQL}, counts AS (SELECT dealer_vehicle_id % {len(ML.LINES)} AS line, count(*) AS n FROM vehicles GROUP BY 1)",
)


def _unmapped_inventory(t):
    inventory = t("inventory_month", "allocation_group department accounting_month year make model model_id style_id style_name trim part_no")
    inventory = _with_line(inventory.withColumn("style_id", F.col("part_no") % len(ML.LINES)), "part_no")
    return AG.map_inventory(inventory, _line_groups(t), _vans(t), date(1995, 6, 1), 2018)


register(
    "inventory_group_mapping", "style_id:i year:i make model model_id style_name trim allocation_group", _unmapped_inventory,
    f"""SELECT DISTINCT m.line AS style_id, year, m.make, m.model, m.model_id, m.style_name, m.trim, coalesce(in_stock, 'nomap') AS allocation_group
    FROM inventory_month i JOIN mapped m ON m.line = part_no % {len(ML.LINES)}
    WHERE i.allocation_group = 'nomap' AND department = '300' AND accounting_month > DATE '1995-06-01' AND year > 2018 AND m.make <> 'Kia'""",
    ("inventory_month", "vehicles"), _LINE_GROUPS,
)


def _orders_by_line(t):
    return _with_line(t("orders_daily", "update_date model_year make model model_number trim alloc_group customer_no"), "customer_no").withColumn("model_number", F.col("model_id"))


register(
    "pipeline_group_mapping", "model_year:i make model model_id trim allocation_group was_missing:b",
    lambda t: AG.map_pipeline(
        _orders_by_line(t), t("inventory_month", "model_id allocation_group year accounting_month"), _line_groups(t), _vans(t), date(1997, 2, 27), 2019
    ),
    f"""SELECT DISTINCT model_year, m.make, m.model, m.model_id, m.trim, coalesce(on_order, CASE WHEN h.g IS NULL THEN 'nomap' ELSE coalesce(p.g, 'nomap') END) AS allocation_group,
      on_order IS NULL AS was_missing
    FROM orders_daily o JOIN mapped m ON m.line = customer_no % {len(ML.LINES)} LEFT JOIN hist h ON h.model_id = m.model_id
      LEFT JOIN grp p ON p.k = upper(m.make || '_' || h.g)
    WHERE update_date > DATE '1997-02-27' AND model_year > 2019 AND (alloc_group = 'nomap' OR alloc_group = '' OR alloc_group IS NULL)""",
    ("orders_daily", "inventory_month", "vehicles"),
    f"""{_LINE_GROUPS}, hist AS (SELECT model_id, allocation_group AS g FROM (SELECT model_id, allocation_group, row_number() OVER (PARTITION BY model_id
        ORDER BY year DESC, accounting_month DESC, allocation_group DESC) AS rn FROM inventory_month) x WHERE rn = 1)""",
)


register(
    "history_backfill", "model_id model units:i allocation_group was_missing:b",
    lambda t: LK.backfill_from_history(
        t("inventory_month", "model_id model allocation_group").groupBy("model_id", "model", "allocation_group").agg(F.count(F.lit(1)).alias("units")),
        t("inventory_month", "model_id allocation_group year accounting_month balance").filter("allocation_group <> 'nomap' OR balance IS NULL").select("model_id", "allocation_group", "year", "accounting_month"),
        "model_id", "allocation_group", ["year", "accounting_month"], "nomap",
    ),
    """SELECT m.model_id, model, count(*) AS units, CASE WHEN m.allocation_group = 'nomap' THEN coalesce(h.g, 'nomap') ELSE m.allocation_group END AS allocation_group,
      m.allocation_group = 'nomap' AS was_missing FROM inventory_month m LEFT JOIN hist h ON h.model_id = m.model_id
    GROUP BY m.model_id, model, m.allocation_group, h.g""", ("inventory_month",),
    """hist AS (SELECT model_id, allocation_group AS g FROM (SELECT model_id, allocation_group, row_number() OVER (PARTITION BY model_id
      ORDER BY year DESC, accounting_month DESC, allocation_group DESC) AS rn FROM inventory_month WHERE allocation_group <> 'nomap' OR balance IS NULL) x WHERE rn = 1)""",
)
register(
    "max_per", "vin event_id:i internet_price:d top_price:d",
    lambda t: LK.max_per(t.inventory_daily.select("vin", "event_id", "internet_price"), ["vin"], "internet_price", "top_price"),
    "SELECT vin, event_id, internet_price, max(internet_price) OVER (PARTITION BY vin) AS top_price FROM inventory_daily", ("inventory_daily",),
)

# --- scalars ------------------------------------------------------------------------------

register(
    "first_cap", "make capped units:i",
    lambda t: t("sales_detail", "make sold_count").groupBy("make", TX.first_cap(F.col("make")).alias("capped")).agg(F.sum("sold_count").alias("units")),
    "SELECT make, upper(left(make, 1)) || lower(substring(make, 2)) AS capped, sum(sold_count) AS units FROM sales_detail GROUP BY 1, 2", ("sales_detail",),
)
register(
    "id_cleanup", "raw clean orders:i",
    lambda t: t.orders.select(
        F.when(F.col("o_orderstatus") == "F", F.concat((F.col("o_custkey") % 100).cast("string"), F.lit(".0")))
        .when(F.col("o_orderstatus") == "O", F.concat(F.lit("x"), (F.col("o_custkey") % 100).cast("string")))
        .otherwise((F.col("o_custkey") % 100).cast("string")).alias("raw")
    ).groupBy("raw", TX.id_cleanup(F.col("raw")).alias("clean")).agg(F.count(F.lit(1)).alias("orders")),
    """SELECT raw, coalesce(CAST(CAST(TRY_CAST(raw AS DOUBLE) AS BIGINT) AS VARCHAR), raw) AS clean, count(*) AS orders FROM (SELECT CASE o_orderstatus
      WHEN 'F' THEN (o_custkey % 100) || '.0' WHEN 'O' THEN 'x' || (o_custkey % 100) ELSE CAST(o_custkey % 100 AS VARCHAR) END AS raw FROM orders) x GROUP BY 1, 2""",
)
register(
    "row_aggregates", "event_id:i mean_price:d present:i",
    lambda t: t.inventory_daily.select(
        "event_id", MS.row_mean(F.col("price_tier_93"), F.col("price_tier_95")).alias("mean_price"),
        MS.row_nonnull(F.col("price_tier_93"), F.col("price_tier_95"), F.col("good_price")).alias("present"),
    ),
    """SELECT event_id, CASE WHEN price_tier_93 IS NOT NULL OR price_tier_95 IS NOT NULL THEN CAST(coalesce(price_tier_93, 0) + coalesce(price_tier_95, 0) AS DOUBLE)
      / (CASE WHEN price_tier_93 IS NULL THEN 0 ELSE 1 END + CASE WHEN price_tier_95 IS NULL THEN 0 ELSE 1 END) END AS mean_price,
      CASE WHEN price_tier_93 IS NULL THEN 0 ELSE 1 END + CASE WHEN price_tier_95 IS NULL THEN 0 ELSE 1 END + CASE WHEN good_price IS NULL THEN 0 ELSE 1 END AS present
    FROM inventory_daily""", ("inventory_daily",),
)
register(
    "sum_if_max", "store_id vin_prefix over_45:i over_120:i",
    lambda t: t("inventory_month", "store_id model accounting_month days_in_inventory_group inventory_count").groupBy("store_id", F.col("model").alias("vin_prefix"), "accounting_month").agg(
        MS.sum_if_max(F.col("days_in_inventory_group"), 45, F.col("inventory_count")).alias("a"),
        MS.sum_if_max(F.col("days_in_inventory_group"), 120, F.col("inventory_count")).alias("b"),
    ).groupBy("store_id", "vin_prefix").agg(F.sum("a").alias("over_45"), F.sum("b").alias("over_120")),
    """SELECT store_id, model AS vin_prefix, sum(CASE WHEN m > 45 THEN s ELSE 0 END) AS over_45, sum(CASE WHEN m > 120 THEN s ELSE 0 END) AS over_120
    FROM (SELECT store_id, model, accounting_month, max(abs(days_in_inventory_group)) AS m, sum(inventory_count) AS s FROM inventory_month GROUP BY 1, 2, 3) x
    GROUP BY 1, 2""", ("inventory_month",),
)

# --- stacking and history ---------------------------------------------------------------------

_FACT = "accounting_month:t make inv:i sold:i"


def _inv_side(t):
    return t("inventory_month", "accounting_month make inventory_count").groupBy("accounting_month", "make").agg(F.sum("inventory_count").alias("inv"))


def _sold_side(t):
    return t("sales_detail", "accounting_month make sold_count").groupBy("accounting_month", "make").agg(F.sum("sold_count").alias("sold"))


register(
    "stacked_facts", _FACT, lambda t: ST.stack_facts([_inv_side(t), _sold_side(t)], {"inv": 0, "sold": 0}),
    """SELECT accounting_month, make, sum(inventory_count) AS inv, 0 AS sold FROM inventory_month GROUP BY 1, 2
    UNION ALL SELECT accounting_month, make, 0, sum(sold_count) FROM sales_detail GROUP BY 1, 2""", ("inventory_month", "sales_detail"),
)
register(
    "combine_frames", "accounting_month:t inv:i make sold:i",
    lambda t: ST.combine_frames([_inv_side(t).withColumn("empty", F.lit(None).cast("string")), _sold_side(t)]),
    """SELECT accounting_month, make, sum(inventory_count) AS inv, NULL AS sold FROM inventory_month GROUP BY 1, 2
    UNION ALL SELECT accounting_month, make, NULL, sum(sold_count) FROM sales_detail GROUP BY 1, 2""", ("inventory_month", "sales_detail"),
)


def _snapshots(t):
    sums = t("sales_detail", "accounting_month store_id sold_count front_gross").groupBy("accounting_month", "store_id").agg(F.sum("sold_count").alias("units"), F.sum("front_gross").alias("gross"))
    history = sums.filter(F.col("accounting_month") <= F.lit(date(1999, 8, 1))).withColumnRenamed("accounting_month", "date")
    return history, sums.filter(F.col("accounting_month") == F.lit(date(1999, 9, 1))).drop("accounting_month")


register(
    "roll_history", "date:t store_id units:i gross:d", lambda t: H.roll_history(*_snapshots(t), "date", AS_OF),
    """SELECT CASE WHEN accounting_month >= DATE '1999-08-01' THEN DATE '1999-08-20' ELSE accounting_month END AS date, store_id,
      sum(sold_count) AS units, sum(front_gross) AS gross FROM sales_detail
    WHERE accounting_month <= DATE '1999-09-01' AND accounting_month > (SELECT min(accounting_month) FROM sales_detail) GROUP BY accounting_month, store_id""",
    ("sales_detail",),
)


def _weekly(t):
    history, new = _snapshots(t)
    versions = K.roll_weekly({"units": (history.drop("gross"), new.drop("gross")), "gross": (history.drop("units"), new.drop("units"))}, "date", AS_OF)
    return ST.stack_facts(list(versions.values()))


register(
    "roll_weekly", "date:t store_id units:i gross:d", _weekly,
    """SELECT CASE WHEN accounting_month >= DATE '1999-08-01' THEN DATE '1999-08-20' ELSE accounting_month END AS date, store_id,
      CASE k WHEN 1 THEN sum(sold_count) END AS units, CASE k WHEN 2 THEN sum(front_gross) END AS gross FROM sales_detail CROSS JOIN (VALUES (1), (2)) v(k)
    WHERE accounting_month <= DATE '1999-09-01' AND accounting_month > (SELECT min(accounting_month) FROM sales_detail) GROUP BY accounting_month, store_id, k""",
    ("sales_detail",),
)


def _period_tables(t):
    sums = t("sales_detail", "accounting_month store_id sold_count").groupBy(F.year("accounting_month").alias("year"), F.month("accounting_month").alias("mth"), "store_id").agg(
        F.sum("sold_count").alias("units")
    )
    return sums, sums.filter("year = 1999 AND mth >= 6").withColumn("units", F.col("units") * 10)


_PERIOD = """sums AS (SELECT year(accounting_month) AS year, month(accounting_month) AS mth, store_id, sum(sold_count) AS units FROM sales_detail GROUP BY 1, 2, 3)"""
register(
    "replace_period", "year:i mth:i store_id units:i", lambda t: H.replace_period(*_period_tables(t), ["year", "mth"]),
    "SELECT year, mth, store_id, CASE WHEN year = 1999 AND mth >= 6 THEN units * 10 ELSE units END AS units FROM sums", ("sales_detail",), _PERIOD,
)
register(
    "upsert_month", "year:i mth:i store_id units:i", lambda t: K.upsert_month(*_period_tables(t), date(1999, 8, 1)),
    "SELECT year, mth, store_id, CASE WHEN year = 1999 AND mth = 8 THEN units * 10 ELSE units END AS units FROM sums", ("sales_detail",), _PERIOD,
)


def _upserted(t):
    """A history of orders by month; a delivery repeats 1997 and 1998 in other tasks, with every third month changed, and adds a
    month.  Per month: its rows and keys, what was done, and whether the table still has the file names of before."""
    path = new_path(t.spark, "history")
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", F.date_format("o_orderdate", "yyyyMM").alias("year_month"))
    SK.upsert_changed(rows, path, ["year_month"])

    def names():
        return FS.list_files(t.spark, path).filter(F.col("path").contains("year_month=")).groupBy(
            F.regexp_extract("path", "year_month=([^/]*)", 1).alias("year_month")
        ).agg(F.array_sort(F.collect_set("path")).alias("files"))

    before = written(names(), "before")
    changed = F.col("year_month").cast("int") % 3 == 0
    delivery = rows.filter("year_month BETWEEN '199701' AND '199812'").repartition(7).withColumn(
        "o_orderstatus", F.when(changed & (F.col("o_orderstatus") == "O"), "X").otherwise(F.col("o_orderstatus"))
    )
    new = rows.filter("year_month = '199701'").withColumn("year_month", F.lit("209901"))
    report = SK.upsert_changed(delivery.unionByName(new), path, ["year_month"])
    held = t.spark.read.schema(rows.schema).parquet(path).groupBy("year_month").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("o_orderkey").alias("keys"), F.count_if(F.col("o_orderstatus") == "X").alias("changed")
    )
    after = names().withColumnRenamed("files", "now")
    return held.join(report.select("year_month", "action"), "year_month", "left").join(before, "year_month", "left").join(
        after, "year_month"
    ).withColumn("same_files", F.coalesce(F.col("files") == F.col("now"), F.lit(False)))


register(
    "upsert_changed", "year_month orders:i keys:i changed:i action same_files:b", _upserted,
    """SELECT year_month, count(*) AS orders, sum(k) AS keys, CAST(sum(CASE WHEN done = 'replaced' AND st = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS changed,
      done AS action, done IS NULL OR done = 'kept' AS same_files
    FROM (SELECT *, CASE WHEN year_month = '209901' THEN 'added' WHEN year_month BETWEEN '199701' AND '199812' THEN
        CASE WHEN CAST(year_month AS INT) % 3 = 0 AND bool_or(st = 'O') OVER (PARTITION BY year_month) THEN 'replaced' ELSE 'kept' END END AS done
      FROM (SELECT strftime(o_orderdate, '%Y%m') AS year_month, o_orderkey AS k, o_orderstatus AS st FROM orders
        UNION ALL SELECT '209901', o_orderkey, o_orderstatus FROM orders WHERE strftime(o_orderdate, '%Y%m') = '199701') o) x GROUP BY year_month, done""",
)
register(
    "append_months", "sale_year:i sale_month:i make units:i",
    lambda t: H.append_months(t("sales_current", "sale_year sale_month make mtd_sales"), t("sales_history", "sale_year sale_month make mtd_sales"), [1, 2, 3], [2000, 2001]).groupBy("sale_year", "sale_month", "make").agg(
        F.sum("mtd_sales").alias("units")
    ),
    """SELECT sale_year, sale_month, make, sum(mtd_sales) AS units FROM (SELECT * FROM sales_history UNION ALL
      SELECT * FROM sales_current WHERE sale_month <= 3 AND sale_year >= 2000) x GROUP BY 1, 2, 3""", ("sales_current", "sales_history"),
)
register(
    "current_plus_history", "sale_year:i sale_month:i units:i",
    lambda t: ST.stack_facts([drop_overlap(t("sales_current", "sale_year sale_month mtd_sales"), MARKET_AS_OF), t("sales_history", "sale_year sale_month mtd_sales")]).groupBy("sale_year", "sale_month").agg(
        F.sum("mtd_sales").alias("units")
    ),
    "SELECT sale_year, sale_month, sum(mtd_sales) AS units FROM market_sales GROUP BY 1, 2", ("market_sales",),
)

# --- pages, documents, questions -----------------------------------------------------------------

register(
    "page_records", "page_id:i position:i target label",
    lambda t: X.extract_records(t.pages, ["page_id"], "html", r'<a href="([^"]*)">([^<]*)</a>', ["target", "label"]),
    """SELECT page_id, i - 1 AS position, regexp_extract(m, '<a href="([^"]*)">([^<]*)</a>', 1) AS target, regexp_extract(m, '<a href="([^"]*)">([^<]*)</a>', 2) AS label
    FROM (SELECT page_id, unnest(ms) AS m, generate_subscripts(ms, 1) AS i FROM (SELECT page_id, regexp_extract_all(html, '<a href="[^"]*">[^<]*</a>') AS ms FROM pages) a) b""",
)
register(
    "json_locations", "page_id:i position:i store_name city state", lambda t: K.json_locations(t.location_pages),
    """SELECT page_id, k AS position, s_name || CASE k WHEN 1 THEN ' East' ELSE '' END AS store_name, n_name AS city, r_name AS state
    FROM location_pages CROSS JOIN (VALUES (0), (1)) v(k)""", ("location_pages",),
)
register(
    "page_blocks", "page_id:i position:i name value", lambda t: K.card_locations(t.location_pages, "name", "addr"),
    """SELECT page_id, k AS position, CASE k WHEN 1 THEN s_name ELSE n_name END || ' & Sons' AS name,
      CASE WHEN acctbal < 2000 THEN '' ELSE n_name || ' Street' || chr(10) || r_name END AS value
    FROM location_pages CROSS JOIN (VALUES (1), (2)) v(k)""", ("location_pages",),
)
register(
    "popup_locations", "page_id:i position:i name street city state_zip full_address", lambda t: K.popup_locations(t.location_pages),
    """SELECT page_id, 0 AS position, s_name AS name, page_id || ' Main St, Suite 1' AS street, n_name AS city, r_name || ' 12345' AS state_zip,
      page_id || ' Main St, Suite 1, ' || n_name || ', ' || r_name || ' 12345' AS full_address FROM location_pages""", ("location_pages",),
)


def _cards(t):
    """Whole pages inside two cards, one in the other, behind a comment and a value that look like tags."""
    head, inner = "<div data-n='<div>' class=\"card\">a<!-- <div> -->", '<div title="</div>" class=\'inner card\'>'
    whole = t.pages.select("page_id", F.concat(F.lit(head), F.lit(inner), F.coalesce("html", F.lit("")), F.lit("</DIV>b</div>")).alias("whole"))
    blocks = TG.nested_blocks(whole, ["page_id"], "whole", "div", {"class": "card"})
    return blocks.select(
        "page_id", "position", F.md5("block").alias("block"), TG.first_text(F.col("block"), "h1").alias("title"),
        TG.first_text(F.col("block"), "div", {"class": "ad"}).alias("ad"), TG.first_text(F.col("block"), "aside").alias("aside"),
        F.size(TG.element_texts(F.col("block"), "li")).alias("items"),
    )


register(
    "nested_blocks", "page_id:i position:i block title ad aside items:i", _cards,
    """SELECT page_id, k AS position, md5(CASE k WHEN 0 THEN 'a<div title="</div>" class=''inner card''>' || plain || '</DIV>b' ELSE plain END) AS block,
      trim(replace(replace(replace(replace(regexp_extract(plain, '<h1>([^<]*)</h1>', 1), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&')) AS title,
      trim(replace(replace(replace(replace(regexp_extract(plain, '<div class="ad">([^<]*)</div>', 1), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&')) AS ad, '' AS aside,
      len(regexp_extract_all(plain, '<li>')) AS items
    FROM (SELECT page_id, regexp_replace(html, '<!--.*?-->', '', 'gs') AS plain FROM pages) p CROSS JOIN (VALUES (0), (1)) v(k)""",
)
_WORDS = ["License", "license", "Training", "contact"]
register(
    "keyword_lines", "doc_id:i line_no:i line", lambda t: X.keyword_lines(t.documents, ["doc_id"], "text", _WORDS),
    """SELECT doc_id, i - 1 AS line_no, trim(line, ' ') AS line FROM (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i
      FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents) a) b
    WHERE contains(line, 'License') OR contains(line, 'license') OR contains(line, 'Training') OR contains(line, 'contact')""",
)
register(
    "key_value", "doc_id:i value", lambda t: X.key_value(t.documents, ["doc_id"], "text", "(?:[Tt]oken ?[:=]|[Pp]assword[:=])"),
    """SELECT doc_id, list_extract(m, -1) AS value FROM (SELECT doc_id, regexp_extract_all(text, '(?:[Tt]oken ?[:=]|[Pp]assword[:=])\\s*(\\S+)', 1) AS m FROM documents) x
    WHERE len(m) > 0""",
)
register(
    "lines_to_columns", "conv_id:i turn:i first_cell cells:i",
    lambda t: X.lines_to_columns(t.conversations, "text").select(
        "conv_id", "turn", F.get("cells", F.lit(0)).alias("first_cell"), F.size("cells").alias("cells")
    ),
    "SELECT conv_id, turn, trim(split_part(text, ',', 1), ' ') AS first_cell, len(string_split(text, ',')) AS cells FROM conversations",
)

PHRASES = {"retail units": "retail units", "core pvr": "core gross", "variable gross": "variable gross", "base retail gross": "base retail"}
_METRICS = ["retail units", "core gross", "variable gross", "base retail"]


def _scorecard(t):
    return t.scorecard_rows.groupBy("month", "year", "store", "brand").agg(
        *[F.round(c).cast("double").alias(n) for c, n in zip(
            (F.sum("units"), F.sum("gross"), F.max("retail"), F.sum("retail")),
            ("retail units", "core gross", "variable gross", "base retail"),
        )]
    )


def _catalogues(t):
    stores = t.nation.select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("position"))
    brands = t.region.select(F.col("r_name").alias("name"), F.col("r_regionkey").alias("position"))
    return stores, brands


def _large_catalogues(t):
    """The catalogue with every customer's name behind it, which no question holds."""
    stores, brands = _catalogues(t)
    return stores.unionByName(t.customer.select(F.col("c_name").alias("name"), (F.col("c_custkey") + 1000).alias("position"))), brands


def _resolved(t):
    return Q.resolve_questions(t.questions, PHRASES, *_catalogues(t))


_MONTH_CASE = " ".join(f"WHEN contains(q, '{m}') THEN {i}" for i, m in enumerate(D.MONTH_NAMES, 1))
_RESOLVED = f"""resolved AS (SELECT question_id, CASE {_MONTH_CASE} END AS month, CAST(nullif(regexp_extract(q, '\\b(20[0-9][0-9])\\b', 1), '') AS INT) AS year,
    q LIKE '%what store%' OR q LIKE '%which store%' OR q LIKE '%what location%' AS asks_store, q LIKE '%what brand%' OR q LIKE '%which brand%' AS asks_brand,
    CASE WHEN q LIKE '%average%' OR q LIKE '%avg%' OR q LIKE '%mean%' THEN 'mean' WHEN q LIKE '%max%' OR q LIKE '%highest%' THEN 'max'
      WHEN q LIKE '%min%' OR q LIKE '%lowest%' THEN 'min' WHEN q LIKE '%count%' OR q LIKE '%how many%' THEN 'count' ELSE 'sum' END AS operation,
    CASE WHEN contains(q, 'variable gross') THEN 'variable gross' WHEN contains(q, 'retail units') THEN 'retail units' WHEN contains(q, 'core pvr') THEN 'core gross'
      WHEN list_has_any(string_split(q, ' '), ['retail', 'units']) THEN 'retail units' WHEN list_contains(string_split(q, ' '), 'gross') THEN 'core gross' END AS metric,
    CASE WHEN q LIKE '%which store%' THEN NULL ELSE (SELECT arg_min(n_name, n_nationkey) FROM nation WHERE contains(q, lower(n_name))) END AS store,
    CASE WHEN q LIKE '%what brand%' OR q LIKE '%which brand%' THEN NULL ELSE (SELECT arg_min(r_name, r_regionkey) FROM region WHERE contains(q, lower(r_name))) END AS brand
  FROM (SELECT question_id, lower(question) AS q FROM questions) x)"""
_RESOLVED_SPEC = "question_id:i month:i year:i store brand operation metric asks_store:b asks_brand:b"
register("questions_resolved", _RESOLVED_SPEC, _resolved, "SELECT * FROM resolved", ("questions",), _RESOLVED)
register(
    "questions_resolved_large", _RESOLVED_SPEC, lambda t: Q.resolve_questions(t.questions, PHRASES, *_large_catalogues(t)),
    "SELECT * FROM resolved", ("questions",), _RESOLVED,
)
_SCORE = """score AS (SELECT month, year, store, brand, CAST(round(sum(units)) AS DOUBLE) AS u, CAST(round(sum(gross)) AS DOUBLE) AS c, CAST(round(max(retail)) AS DOUBLE) AS v
    FROM scorecard_rows GROUP BY 1, 2, 3, 4),
  long_rows AS (SELECT month, year, store, brand, 'retail units' AS metric, u AS value FROM score UNION ALL SELECT month, year, store, brand, 'core gross', c FROM score
    UNION ALL SELECT month, year, store, brand, 'variable gross', v FROM score),
  asked AS (SELECT DISTINCT month, year, store, brand, metric FROM resolved WHERE metric IS NOT NULL),
  facts AS (SELECT a.month, a.year, a.store, a.brand, a.metric, sum(l.value) AS s, avg(l.value) AS m, max(l.value) AS hi, min(l.value) AS lo, count(l.value) AS n,
      min(l.store) FILTER (WHERE l.value = x.lo) AS low_store, min(l.store) FILTER (WHERE l.value = x.hi) AS high_store,
      min(l.brand) FILTER (WHERE l.value = x.lo) AS low_brand, min(l.brand) FILTER (WHERE l.value = x.hi) AS high_brand
    FROM asked a LEFT JOIN long_rows l ON l.metric = a.metric AND (a.month IS NULL OR l.month = a.month) AND (a.year IS NULL OR l.year = a.year)
      AND (a.store IS NULL OR l.store = a.store) AND (a.brand IS NULL OR l.brand = a.brand)
    LEFT JOIN (SELECT a.month, a.year, a.store, a.brand, a.metric, min(l.value) AS lo, max(l.value) AS hi FROM asked a JOIN long_rows l ON l.metric = a.metric
      AND (a.month IS NULL OR l.month = a.month) AND (a.year IS NULL OR l.year = a.year) AND (a.store IS NULL OR l.store = a.store)
      AND (a.brand IS NULL OR l.brand = a.brand) GROUP BY 1, 2, 3, 4, 5) x
      ON x.metric = a.metric AND x.month IS NOT DISTINCT FROM a.month AND x.year IS NOT DISTINCT FROM a.year AND x.store IS NOT DISTINCT FROM a.store
      AND x.brand IS NOT DISTINCT FROM a.brand
    GROUP BY 1, 2, 3, 4, 5)"""


def _answers(t):
    return K.scorecard_answers(t.questions, _scorecard(t), *_catalogues(t), PHRASES)


register(
    "question_answers", "question_id:i metric operation value:r entity", _answers,
    """SELECT question_id, r.metric, operation, CASE WHEN r.metric IS NULL THEN NULL ELSE CASE operation WHEN 'sum' THEN coalesce(s, 0) WHEN 'mean' THEN m WHEN 'max' THEN hi WHEN 'min' THEN lo ELSE n END END AS value,
      CASE WHEN asks_store AND operation = 'max' THEN high_store WHEN asks_store AND operation = 'min' THEN low_store
        WHEN asks_brand AND operation = 'max' THEN high_brand WHEN asks_brand AND operation = 'min' THEN low_brand END AS entity
    FROM resolved r LEFT JOIN facts f ON f.metric = r.metric AND f.month IS NOT DISTINCT FROM r.month AND f.year IS NOT DISTINCT FROM r.year
      AND f.store IS NOT DISTINCT FROM r.store AND f.brand IS NOT DISTINCT FROM r.brand""", ("questions", "scorecard_rows"), f"{_RESOLVED}, {_SCORE}",
)


register(
    "metric_answer", "operation value:r",
    lambda t: ST.stack_facts([
        MS.metric_answer(_scorecard(t), "retail units", op).withColumn("operation", F.lit(op)) for op in MS.METRIC_OPERATIONS
    ]),
    """SELECT unnest(['sum', 'mean', 'max', 'min', 'count']) AS operation, unnest([sum(u), avg(u), max(u), min(u), CAST(count(u) AS DOUBLE)]) AS value FROM (
      SELECT CAST(round(sum(units)) AS DOUBLE) AS u FROM scorecard_rows GROUP BY month, year, store, brand) x""", ("scorecard_rows",),
)
register(
    "argmax_entity", "brand best worst",
    lambda t: _scorecard(t).groupBy("brand").agg(
        MS.arg_extreme(F.col("store"), F.col("retail units")).alias("best"),
        MS.arg_extreme(F.col("store"), F.col("retail units"), largest=False).alias("worst"),
    ),
    """SELECT brand, (list(store ORDER BY u DESC, store))[1] AS best, (list(store ORDER BY u, store))[1] AS worst FROM (
      SELECT month, year, store, brand, sum(units) AS u FROM scorecard_rows GROUP BY 1, 2, 3, 4) x GROUP BY brand""", ("scorecard_rows",),
)

# --- files ---------------------------------------------------------------------------------------

_TENANTS = {"1-URGENT": "North Co", "2-HIGH": "South Co", "3-MEDIUM": "West Co", "4-NOT": "East Co", "LOW": "Hill Co"}
CHUNK_ORDERS = 500_000


def _tenant_files(t) -> str:
    """The orders as CSV files of five tenants, a file per tenant and key range, each with a footer.
    West Co's files name the unit in a column of their own; some units have quotes and a line break."""
    rows = t.orders.select(
        F.replace("o_orderpriority", F.lit(" "), F.lit("_")).alias("tenant_dir"),
        F.floor(F.col("o_orderkey") / CHUNK_ORDERS).alias("chunk"), F.lit(0).alias("kind"),
        F.col("o_orderkey").cast("string").alias("Payment ID"),
        F.concat(F.when(F.col("o_custkey") % 7 == 0, F.lit('The "Unit",\n')).otherwise(F.lit("Unit, ")), "o_orderstatus").alias("Payment Business Unit"),
        F.when(F.col("o_custkey") % 10 == 0, "n/a").otherwise(F.col("o_totalprice").cast("string")).alias("Payment Amount"),
        F.lit(None).cast("string").alias("Refund Reason"),
    )
    footers = rows.groupBy("tenant_dir", "chunk").agg(F.count(F.lit(1)).cast("string").alias("Payment Amount")).select(
        "tenant_dir", "chunk", F.lit(1).alias("kind"), F.lit("Total").alias("Payment ID"), F.lit("").alias("Payment Business Unit"),
        "Payment Amount", F.lit(None).cast("string").alias("Refund Reason"),
    )
    path = new_path(t.spark, "tenants")
    lines = rows.unionByName(footers)
    west = F.col("tenant_dir").startswith("3-MEDIUM")
    for part in (lines.where(~west), lines.where(west).withColumnRenamed("Payment Business Unit", "Unit Of West")):
        (
            part.repartition("tenant_dir", "chunk").sortWithinPartitions("tenant_dir", "chunk", "kind").drop("kind")
            .write.mode("append").partitionBy("tenant_dir", "chunk").option("header", True).option("escape", '"').option("encoding", "ISO-8859-1").csv(path)
        )
    return path


def _file_combine(t):
    report = K.tenant_report(
        t.spark, _tenant_files(t), None, _TENANTS, K.PAYMENT_NAMES, K.PAYMENT_TYPES, match_on="file_path"
    )
    return report.withColumn("business_unit", F.coalesce("business_unit", "Unit Of West"))


register(
    "file_combine", "payment_id business_unit payment_amount:d tenant", _file_combine,
    """SELECT CAST(o_orderkey AS VARCHAR) AS payment_id, CASE WHEN o_custkey % 7 = 0 THEN 'The "Unit",' || chr(10) ELSE 'Unit, ' END || o_orderstatus AS business_unit,
      CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE o_totalprice END AS payment_amount,
      CASE left(o_orderpriority, 1) WHEN '1' THEN 'North Co' WHEN '2' THEN 'South Co' WHEN '3' THEN 'West Co' WHEN '4' THEN 'East Co' ELSE 'Hill Co' END AS tenant
    FROM orders""",
)


def _delimited(t):
    path = new_path(t.spark, "delimited")
    t.customer.select("c_custkey", "c_name", "c_acctbal").write.option("header", True).option("sep", "|").csv(path)
    frame = FS.read_delimited(t.spark, path, "c_custkey string, c_name string, c_acctbal string", sep="|")
    return FS.standardize(frame, {"c_custkey": "key"}, {"key": "bigint", "c_acctbal": "double"})


register(
    "read_delimited", "key:i c_name c_acctbal:d", _delimited, "SELECT c_custkey AS key, c_name, c_acctbal FROM customer",
)


def _newest(t):
    folder = new_path(t.spark, "deliveries")
    for part, name in ((0, "skip_daily"), (1, "daily")):
        SK.write_csv(t.nation.where(F.col("n_regionkey") % 2 == part).select("n_nationkey", "n_name"), f"{folder}/{name}", ["n_nationkey"])
    found = FS.latest_file(t.spark, f"{folder}/daily", ["part-"], ["skip"])
    return FS.read_delimited(t.spark, found, "key bigint, n_name string")


register(
    "latest_file", "key:i n_name", _newest,
    "SELECT n_nationkey AS key, n_name FROM nation WHERE n_regionkey % 2 = 1",
)


def _newest_orders(t):
    """Two whole deliveries of the orders, the older one without their status; all rows of the newer."""
    folder = new_path(t.spark, "deliveries")
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    SK.write_csv(rows.withColumn("o_orderstatus", F.lit("open")), f"{folder}/z_first")
    SK.write_csv(rows, f"{folder}/a_second")
    delivery = FS.latest_file(t.spark, folder, ["part-"]).rpartition("/")[0]
    return FS.read_delimited(t.spark, delivery, "key bigint, customer bigint, status string")


register(
    "latest_file_orders", "key:i customer:i status", _newest_orders,
    "SELECT o_orderkey AS key, o_custkey AS customer, o_orderstatus AS status FROM orders",
)


def _replaced(t):
    whole, parts = new_path(t.spark, "whole"), new_path(t.spark, "parts")
    rows = t.orders.select("o_orderkey", "o_orderpriority", "o_orderstatus")
    for status in ("O", "F"):  # the second write replaces all of the first
        SK.replace_table(rows.where(F.col("o_orderstatus") == status), whole)
    SK.replace_partitions(rows.withColumn("o_orderkey", F.lit(0).cast("long")), parts, ["o_orderstatus"])
    SK.replace_partitions(t.spark.read.schema(rows.schema).parquet(whole), parts, ["o_orderstatus"])
    return (
        t.spark.read.schema(rows.schema).parquet(parts).groupBy("o_orderstatus")
        .agg(F.count(F.lit(1)).alias("orders"), F.sum("o_orderkey").alias("keys"))
    )


register(
    "replace_tables", "o_orderstatus orders:i keys:i", _replaced,
    """SELECT o_orderstatus, count(*) AS orders, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN o_orderkey ELSE 0 END) AS BIGINT) AS keys
    FROM orders GROUP BY 1""",
)
register(
    "normalize_headers", "S_SUPPKEY:i S_NAME", lambda t: TX.normalize_headers(t.supplier.select(
        F.col("s_suppkey").alias(" s_suppkey\u00a0"), F.col("s_name").alias("s_name ")
    )),
    "SELECT s_suppkey AS S_SUPPKEY, s_name AS S_NAME FROM supplier",
)
register(
    "half_credit", "who orders:d", lambda t: MA.split_credit(
        t.orders.select(
            F.nullif("o_orderstatus", F.lit("P")).alias("a"), F.when(F.col("o_custkey") % 3 == 0, F.col("o_orderpriority")).alias("b"),
            F.lit(1.0).alias("orders"),
        ), "a", "b", "orders", "who",
    ).groupBy("who").agg(F.sum("orders").alias("orders")),
    """SELECT who, sum(part) AS orders FROM (
      SELECT nullif(o_orderstatus, 'P') AS who, CASE WHEN o_custkey % 3 = 0 THEN 0.5 ELSE 1 END AS part FROM orders
      UNION ALL SELECT o_orderpriority, 0.5 FROM orders WHERE o_custkey % 3 = 0) x WHERE who IS NOT NULL GROUP BY 1""",
)
register(
    "clean_html", "page_id:i title", lambda t: t.pages.select(
        "page_id", TX.clean_html(F.concat(F.lit("&lt;i&gt;caf&eacute; &#8211;&#x20;"), F.substring_index("url", "/", -1), F.lit("<br>b&amp;lt;")), "; ").alias("title")
    ),
    """SELECT page_id, trim(regexp_replace('café – ' || list_extract(string_split(url, '/'), -1) || '; b&lt;', '<[^>]*>', '', 'g')) AS title FROM pages""",
)


def _append_once(t):
    source, target = new_path(t.spark, "load"), new_path(t.spark, "loaded")
    rows = t.part.select("p_partkey", F.concat(F.lit('a "'), F.col("p_type"), F.lit('", b')).alias("quoted"))
    rows.write.option("header", True).option("escape", '"').csv(source)
    for _ in range(2):
        loaded = FS.append_csv_once(t.spark, source, "key bigint, quoted string", target)
    return t.spark.read.schema("key bigint, quoted string").parquet(target).withColumn("loaded", F.lit(loaded))


register(
    "append_csv_once", "key:i quoted loaded:i", _append_once,
    """SELECT p_partkey AS key, 'a "' || p_type || '", b' AS quoted, (SELECT count(*) FROM part) AS loaded FROM part""",
)


def _append(t):
    source, target = new_path(t.spark, "load"), new_path(t.spark, "loaded")
    t.supplier.select(F.when(F.col("s_acctbal") < 500, F.lit("broken")).otherwise(F.col("s_suppkey").cast("string")).alias("key"), "s_name").write.option(
        "header", True
    ).csv(source)
    loaded = FS.append_csv(t.spark, source, "key bigint, s_name string", target)
    return t.spark.read.parquet(target).withColumn("loaded", F.lit(loaded))


register(
    "append_csv", "key:i s_name loaded:i", _append,
    "SELECT s_suppkey AS key, s_name, (SELECT count(*) FROM supplier WHERE s_acctbal >= 500) AS loaded FROM supplier WHERE s_acctbal >= 500",
)


def _deliver(t, frame, folder, numbers) -> None:
    """Write the rows of each number as the file ``folder/<number>.csv``, in place of the one before; none: without a byte."""
    draft = new_path(t.spark, "draft")
    frame.repartition("number").write.partitionBy("number").option("header", True).csv(draft)
    path = t.spark._jvm.org.apache.hadoop.fs.Path
    store = path(folder).getFileSystem(t.spark._jsc.hadoopConfiguration())
    store.mkdirs(path(folder))
    for number in numbers:
        store.delete(path(f"{folder}/{number}.csv"), False)
        found = store.globStatus(path(f"{draft}/number={number}/part-*"))
        if len(found):
            store.rename(found[0].getPath(), path(f"{folder}/{number}.csv"))
        else:
            store.create(path(f"{folder}/{number}.csv")).close()


def _load_ledger(t):
    """Three deliveries of the orders in files of eight kinds: the first; the same again; then corrected totals in kind 1,
    half of kind 2, nothing in kind 3 and broken keys in kind 4.  Good and rejected rows of the end, and what each load did."""
    folder, root, schema = new_path(t.spark, "deliveries"), new_path(t.spark, "loaded"), "key bigint, total double"
    number = F.floor(F.col("o_orderkey") / CHUNK_ORDERS) * 8 + F.col("o_orderkey") % 8
    rows = t.orders.select(number.alias("number"), F.col("o_orderkey").cast("string").alias("key"), F.col("o_totalprice").alias("total"))
    files = [r["number"] for r in rows.select("number").distinct().collect()]
    _deliver(t, rows, folder, files)
    done = [LG.load_files(t.spark, folder, schema, root) for _ in range(2)]
    changed = rows.where("number % 8 = 1").withColumn("total", F.col("total") + 1).unionByName(rows.where("number % 8 = 2 and key % 16 = 2"))
    broken = F.when(F.col("total") < 100_000, F.concat(F.lit("broken "), "key")).otherwise(F.col("key"))
    changed = changed.unionByName(rows.where("number % 8 = 4").withColumn("key", broken))
    _deliver(t, changed, folder, [n for n in files if n % 8 in (1, 2, 3, 4)])
    done.append(LG.load_files(t.spark, folder, schema, root))
    counts = F.lit(" ".join(f"{d.files}:{d.rows}:{d.rejected}" for d in done)).alias("loads")
    good = LG.loaded_rows(t.spark, schema, root).select(F.col("key").cast("string").alias("key"), "total", F.lit(False).alias("rejected"), counts)
    bad = LG.rejected_lines(t.spark, schema, root).select(F.split("line", ",")[0].alias("key"), F.lit(None).cast("double").alias("total"), F.lit(True).alias("rejected"), counts)
    return good.unionByName(bad)


register(
    "load_ledger", "key total:d rejected:b loads", _load_ledger,
    """SELECT CASE WHEN o_orderkey % 8 = 4 AND o_totalprice < 100000 THEN 'broken ' || o_orderkey ELSE CAST(o_orderkey AS VARCHAR) END AS key,
      CASE WHEN o_orderkey % 8 = 4 AND o_totalprice < 100000 THEN NULL WHEN o_orderkey % 8 = 1 THEN o_totalprice + 1 ELSE o_totalprice END AS total,
      o_orderkey % 8 = 4 AND o_totalprice < 100000 AS rejected, n AS loads
    FROM orders, (SELECT count(DISTINCT (o_orderkey // 500000) * 8 + o_orderkey % 8) || ':' || count(*) || ':0 0:0:0 '
      || count(DISTINCT (o_orderkey // 500000) * 8 + o_orderkey % 8) FILTER (o_orderkey % 8 BETWEEN 1 AND 4) || ':' || count(*) FILTER (o_orderkey % 8 = 1 OR o_orderkey % 16 = 2 OR o_orderkey % 8 = 4 AND o_totalprice >= 100000)
      || ':' || count(*) FILTER (o_orderkey % 8 = 4 AND o_totalprice < 100000) AS n FROM orders) x
    WHERE o_orderkey % 8 NOT IN (2, 3) OR o_orderkey % 16 = 2""",
)


def _ingested(t):
    folder, table, checkpoint = (new_path(t.spark, n) for n in ("incoming", "periods", "progress"))
    sums = t.orders.groupBy(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")).agg(
        F.count(F.lit(1)).alias("orders"), F.sum(F.col("o_totalprice").cast("decimal(15,2)")).alias("total")
    )
    schema = "year int, month int, orders bigint, total decimal(25,2)"
    for factor in (0, 1):  # a first delivery, then its correction
        frame = sums.withColumn("orders", F.col("orders") * factor)
        frame.repartition("year").write.mode("append").option("header", True).csv(folder)
        ingest_new_files(t.spark, folder, schema, table, checkpoint, ["year", "month"])
    return t.spark.read.schema(schema).parquet(table)


register(
    "stream_ingest", "year:i month:i orders:i total:d", _ingested,
    "SELECT year(o_orderdate) AS year, month(o_orderdate) AS month, count(*) AS orders, sum(CAST(o_totalprice AS DECIMAL(15,2))) AS total FROM orders GROUP BY 1, 2",
)


def _archived(t):
    root = new_path(t.spark, "archive")
    sums = t.inventory_daily.groupBy("store_name").agg(F.count(F.lit(1)).alias("units"))
    SK.archive_snapshot(sums, root, date(2024, 1, 23))
    SK.archive_snapshot(sums.withColumn("units", F.lit(-1).cast("long")), root, date(2024, 1, 23))
    SK.archive_snapshot(sums, root, date(2024, 1, 30))
    return SK.snapshot_at(SK.read_archive(t.spark, root), "as_of", date(2024, 1, 30), 7)


register(
    "archive_snapshot", "store_name units:i as_of:t", _archived,
    "SELECT store_name, count(*) AS units, DATE '2024-01-23' AS as_of FROM inventory_daily GROUP BY 1", ("inventory_daily",),
)

# --- further operators on whole tables ------------------------------------------------------------

register(
    "group_sum_null_keys", "model_number kept:i dropped:i",
    lambda t: _null_key_sums(t),
    """SELECT model_number, count(*) AS kept, CASE WHEN model_number IS NOT NULL THEN count(*) END AS dropped FROM orders_month GROUP BY 1""", ("orders_month",),
)


def _null_key_sums(t):
    ones = t.orders_month.select("model_number", F.lit(1).alias("one"))
    kept = MS.group_sum(ones, ["model_number"], ["one"]).withColumnRenamed("one", "kept")
    dropped = MS.group_sum(ones, ["model_number"], ["one"], drop_null_keys=True).withColumnRenamed("one", "dropped")
    return kept.join(dropped, "model_number", "left")


register(
    "having_any_nonzero", "store_id make sold:i interco:i auction:i any_moved:b total_moved:b",
    lambda t: t("sales_detail", "store_id make accounting_month sold_count interco_count auction_count").groupBy("store_id", "make", "accounting_month").agg(
        F.sum("sold_count").alias("sold"), F.sum("interco_count").alias("interco"), F.sum("auction_count").alias("auction")
    ).withColumn("any_moved", MS.any_nonzero(F.col("sold"), F.col("interco"), F.col("auction")))
    .withColumn("total_moved", MS.total_nonzero(F.col("sold"), F.col("interco"), F.col("auction"))),
    """SELECT *, sold <> 0 OR interco <> 0 OR auction <> 0 AS any_moved, sold + interco + auction <> 0 AS total_moved FROM (SELECT store_id, make, accounting_month,
      sum(sold_count) AS sold, sum(interco_count) AS interco, sum(auction_count) AS auction FROM sales_detail GROUP BY 1, 2, 3) x""", ("sales_detail",),
)
register(
    "pivot_by_status", "make in_transit:i built:i to_be_built:i not_produced:i",
    lambda t: MS.pivot_sum(
        t.orders_month.select("make", "status", F.lit(1).alias("one")), ["make"], "status", "one",
        {"in transit": "in_transit", "BUILT": "built", "TO BE BUILT": "to_be_built", "NOT PRODUCED": "not_produced"},
    ),
    """SELECT make, count(*) FILTER (WHERE status = 'in transit') AS in_transit, count(*) FILTER (WHERE status = 'BUILT') AS built,
      count(*) FILTER (WHERE status = 'TO BE BUILT') AS to_be_built, count(*) FILTER (WHERE status = 'NOT PRODUCED') AS not_produced
    FROM orders_month GROUP BY 1""", ("orders_month",),
)


def _turns(t):
    """What users say, each turn followed by a question that its number picks."""
    turns = t.conversations.filter("role = 'user'")
    asked = F.element_at(F.array(*[F.lit(q) for q in TURN_QUESTIONS]), (F.pmod(F.col("conv_id") + F.col("turn"), F.lit(len(TURN_QUESTIONS))) + 1).cast("int"))
    return turns.select(F.concat_ws("-", "conv_id", "turn").alias("question_id"), F.concat_ws(" ", F.coalesce("text", F.lit("")), asked).alias("question"))


#: Questions that follow a turn's own words.
TURN_QUESTIONS = [
    "how many retail units in march 2024", "what is the average core pvr", "lowest variable gross in december", "", "highest units of 2025", "gross in may",
]
_TURN_QUESTION = "[" + ", ".join(f"'{q}'" for q in TURN_QUESTIONS) + f"][(conv_id + turn) % {len(TURN_QUESTIONS)} + 1]"


register(
    "conversation_questions", "question_id month:i year:i operation metric",
    lambda t: Q.resolve_questions(_turns(t), PHRASES, *_catalogues(t)),
    f"""SELECT conv_id || '-' || turn AS question_id, CASE {_MONTH_CASE} END AS month, CAST(nullif(regexp_extract(q, '\\b(20[0-9][0-9])\\b', 1), '') AS INT) AS year,
      CASE WHEN q LIKE '%average%' OR q LIKE '%avg%' OR q LIKE '%mean%' THEN 'mean' WHEN q LIKE '%max%' OR q LIKE '%highest%' THEN 'max'
        WHEN q LIKE '%min%' OR q LIKE '%lowest%' THEN 'min' WHEN q LIKE '%count%' OR q LIKE '%how many%' THEN 'count' ELSE 'sum' END AS operation,
      CASE WHEN contains(q, 'retail units') THEN 'retail units' WHEN contains(q, 'core pvr') THEN 'core gross' WHEN contains(q, 'variable gross') THEN 'variable gross'
        WHEN regexp_matches(q, '(^|\\s)(retail|units)(\\s|$)') THEN 'retail units' WHEN regexp_matches(q, '(^|\\s)gross(\\s|$)') THEN 'core gross' END AS metric
    FROM (SELECT conv_id, turn, lower(coalesce(text, '') || ' ' || {_TURN_QUESTION}) AS q FROM conversations WHERE role = 'user') x""",
)
