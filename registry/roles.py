"""The reporting roles, derived from the driver's tables.

A role is a list of column expressions over a join of driver tables.  The expressions use
the common part of both SQL dialects; the few functions that differ come from ``Dialect``.
The same text therefore feeds the Spark frames and the views of the DuckDB oracle, while
the reports on top of them are written twice, independently.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import date
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = date(1999, 8, 20)
EVENT_AS_OF = date(2024, 1, 30)
MARKET_AS_OF = date(2000, 8, 20)

MAKES = [
    "CHRYSLER", "DODGE", "JEEP", "RAM", "FIAT", "FORD", "LINCOLN", "BUICK", "CADILLAC", "CHEVROLET", "GMC", "HYUNDAI",
    "GENESIS", "JAGUAR", "LAND ROVER", "ACURA", "HONDA", "TOYOTA", "AUDI", "BMW", "LEXUS", "MERCEDES-BENZ", "MINI",
    "KIA", "",
]
MAKER_NAMES = [
    "Chrysler", "Dodge", "Jeep", "Ram", "Fiat", "Ford", "Lincoln-Mercury", "Buick", "Cadillac", "Chevrolet", "GMC",
    "Hyundai", "Genesis", "Jaguar", "Land Rover", "Acura", "Honda", "Toyota", "Audi", "BMW", "Lexus", "Mercedes",
    "MINI", "Kia", "Lamborghini",
]
DOMINANT = [
    "Chrysler", "Chrysler", "Chrysler", "Chrysler", "", "Ford", "Ford", "GM", "GM", "GM", "GM", "Hyundai", "",
    "Other Luxury", "Other Luxury", "Acura", "Honda", "Toyota", "Other Luxury", "Other Luxury", "Lexus", "Mercedes",
    "Other Luxury", "", "",
]
INDUSTRY_CODES = [
    "CHRY", "DODG", "JEEP", "RAM", "FIAT", "FORD", "LINC", "BUIC", "CADI", "CHEV", "GMCT", "HYUN", "GEN", "JAG", "ROV",
    "ACUR", "HOND", "TOY", "AUDI", "BMW", "LEX", "MB", "MINI", "KIA", "XXXX",
]
SOURCE_CODES = ["Rental-Co", "Leasebuyout", "trade-in", "", "Consign"]
CURRENT_CODES = ["Auction", "ActiveLoaner", "", "WEBUYYOURCAR", "EMCC", "Dealer-Trade", "Inter-Co"]
PLAN_CODES = [
    "TCCM1", "EAM1", "NAM1", "SARFM1", "TCC2_M1", "EA2_M1", "NAM2", "SARFM2", "TCC3_M1", "EA3_M1", "NAM6", "SARFM3",
    "NAM3", "EAM1", "OTHER",
]
LEAD_GROUPS = [
    "TRADE OFFER (VOI)", "RANGE TRADE (VOI)", "SELL ONLY", "RANGE - SELL ONLY", "UNKNOWN", "KBB INSTANT CASH OFFER",
]
ACQUISITION_SOURCES = ["Rental company", "LEASEBUYOUT", "TRADE-IN-USED", "WBYC", "Something else"]


@dataclass(frozen=True)
class Dialect:
    name: str

    def month(self, x: str) -> str:
        return f"CAST(trunc({x}, 'MONTH') AS DATE)" if self.name == "spark" else f"CAST(date_trunc('month', {x}) AS DATE)"

    def days(self, later: str, earlier: str) -> str:
        if self.name == "spark":
            return f"datediff({later}, {earlier})"
        return f"CAST(date_diff('day', CAST({earlier} AS DATE), CAST({later} AS DATE)) AS INT)"

    def add_days(self, x: str, n: str) -> str:
        return f"date_add(CAST({x} AS DATE), {n})" if self.name == "spark" else f"CAST(CAST({x} AS DATE) + ({n}) AS DATE)"

    def year_month(self, x: str) -> str:
        return f"date_format({x}, 'yyyyMM')" if self.name == "spark" else f"strftime({x}, '%Y%m')"

    def pick(self, values: list[str], index: str) -> str:
        items = ", ".join("'" + v + "'" for v in values)
        if self.name == "spark":
            return f"nullif(element_at(array({items}), CAST({index} AS INT)), '')"
        return f"nullif((list_value({items}))[CAST({index} AS INT)], '')"

    def month_name(self, x: str) -> str:
        return f"date_format({x}, 'MMMM')" if self.name == "spark" else f"strftime({x}, '%B')"


SPARK, DUCK = Dialect("spark"), Dialect("duckdb")

PRICE = "CAST(l_extendedprice AS DECIMAL(12,2))"
DISC = "CAST(l_discount AS DECIMAL(4,2))"
TAX = "CAST(l_tax AS DECIMAL(4,2))"
QTY = "CAST(l_quantity AS DECIMAL(12,2))"
TARGET = "CAST(CAST(p_retailprice AS DECIMAL(12,2)) * CAST(l_quantity AS DECIMAL(4,0)) AS DECIMAL(18,4))"
BRAND_NO = "CAST(replace(p_brand, 'Brand#', '') AS INT)"
PRIORITY_NO = "CAST(left(o_orderpriority, 1) AS INT)"
QUESTION_STARTS = [
    "What is the total", "What is the average", "What is the maximum", "Which store has the lowest", "How many", "Which store has the highest",
    "Which brand has the lowest", "What brand has the highest",
]
K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT)"

LINE_STAR = ["lineitem", "orders:o_orderkey=l_orderkey", "part:p_partkey=l_partkey", "supplier:s_suppkey=l_suppkey",
             "nation:n_nationkey=s_nationkey", "region:r_regionkey=n_regionkey"]


def money(x: str) -> str:
    return f"CAST({x} AS DECIMAL(18,4))"


def _unit(d: Dialect) -> str:
    return "concat('V', CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING))"


def _fuel() -> str:
    return ("CASE WHEN p_size <= 20 THEN 'Electric Fuel System' WHEN p_size <= 30 THEN 'Gas/Electric Hybrid' "
            "WHEN p_size <= 35 THEN 'Plug-In Electric/Gas' ELSE 'Gasoline Fuel System' END")


ALLOC = "concat(p_type, '-', CAST(p_size AS STRING))"


def definitions(d: Dialect) -> dict[str, tuple[dict[str, str], list[str]]]:
    """Role -> (columns, joined tables).  A table is ``name:left=right`` after the first."""
    make = d.pick(MAKES, BRAND_NO)
    event_make = d.pick(MAKES, "user_id % 25 + 1")
    event_price = "CAST(floor(value / 10) * 1500 + 4000 AS DECIMAL(18,4))"
    roles: dict[str, tuple[dict[str, str], list[str]]] = {}
    roles["sales_detail"] = ({
        "accounting_month": d.month("o_orderdate"),
        "accounting_date": "CAST(o_orderdate AS DATE)",
        "contract_date": "CAST(o_orderdate AS DATE)",
        "store_id": "CAST(l_suppkey AS STRING)",
        "store_name": "s_name",
        "market_name": "n_name",
        "region_name": "r_name",
        "department": "CASE l_linestatus WHEN 'F' THEN 'New' ELSE 'USED' END",
        "record_source": "CASE o_orderstatus WHEN 'P' THEN 'Sales Log' ELSE 'Accounting' END",
        "sale_type": "CASE l_returnflag WHEN 'R' THEN 'Return' ELSE 'VehicleSale' END",
        "vin": _unit(d),
        "trade_vin": "CASE WHEN l_discount >= 0.05 THEN concat('T', CAST(l_partkey AS STRING)) END",
        "make": make,
        "model": "p_type",
        "trim": "p_name",
        "style_name": "concat(p_type, ' ', p_name)",
        "fuel_type": _fuel(),
        "allocation_group": ALLOC,
        "model_year": "2016 + p_size % 10",
        "mileage": "CAST(l_quantity AS INT) * 1000",
        "sold_count": "CASE WHEN l_linenumber = 7 THEN 0 WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN -1 ELSE 1 END",
        "interco_count": "CASE WHEN l_linenumber = 6 THEN 1 ELSE 0 END",
        "auction_count": "CASE WHEN l_linenumber = 5 THEN 1 ELSE 0 END",
        "fi_count": "CASE WHEN l_tax > 0.04 THEN 1 ELSE 0 END",
        "front_gross": money(f"{PRICE} * {DISC}"),
        "base_retail": money(f"{PRICE} * {TAX}"),
        "incentives": money(f"{QTY} * {DISC}"),
        "fi_gross": money(f"{QTY} * {TAX}"),
        "ovi": money(f"CASE WHEN l_returnflag = 'R' THEN 0 - {QTY} ELSE {QTY} END"),
        "total_gross": money(f"{PRICE} * {DISC} + {QTY}"),
        "interco_gross": money(f"CASE WHEN l_linenumber = 6 THEN {QTY} ELSE 0 END"),
        "auction_gross": money(f"CASE WHEN l_linenumber = 5 THEN {QTY} ELSE 0 END"),
        "front_revenue": money(PRICE),
        "interco_revenue": money(f"CASE WHEN l_linenumber = 6 THEN {PRICE} END"),
        "auction_revenue": money(f"CASE WHEN l_linenumber = 5 THEN {PRICE} END"),
        "front_cos": money(f"{PRICE} - {PRICE} * {DISC}"),
        "cash_price": money(f"CASE WHEN l_linenumber <> 2 THEN {PRICE} END"),
        "target_price": money(f"CASE WHEN l_linenumber <> 3 THEN {TARGET} END"),
        "invoice_price": money(f"{PRICE} - {QTY}"),
        "msrp_adv": money(f"{PRICE} + {QTY}"),
        "recon_cost": money(f"CASE WHEN l_linenumber <> 4 THEN {QTY} END"),
        "non_ro_amount": money(f"{QTY} * {TAX}"),
        "vehicle_age": d.days("l_shipdate", "o_orderdate"),
        "vehicle_age_group": f"CASE WHEN l_linenumber = 1 THEN NULL ELSE {d.days('l_shipdate', 'o_orderdate')} - 3 END",
        "source_type": d.pick(CURRENT_CODES, "l_linenumber"),
        "original_source_code": d.pick(SOURCE_CODES, PRIORITY_NO),
        "source_name": "CASE WHEN p_size = 1 THEN 'From desk Store' ELSE p_name END",
        "cust_no": "CAST(o_custkey AS STRING)",
        "deal_no": "CAST(o_orderkey AS STRING)",
        "ex_service": "o_orderpriority",
    }, LINE_STAR)
    roles["inventory_month"] = ({
        "accounting_month": d.month("l_shipdate"),
        "region_name": "r_name",
        "market_name": "n_name",
        "store_name": "s_name",
        "store_id": "CAST(l_suppkey AS STRING)",
        "department": "CASE l_linestatus WHEN 'F' THEN '300' ELSE '320' END",
        "vin": f"CASE WHEN l_linenumber = 4 AND l_tax = 0 THEN NULL ELSE {_unit(d)} END",
        "year": "2016 + p_size % 10",
        "make": make,
        "model": "p_type",
        "model_id": "concat('M', CAST(p_size AS STRING))",
        "trim": "p_name",
        "style_id": "p_size",
        "part_no": "l_partkey",
        "style_name": "concat(p_type, ' ', p_name)",
        "fuel_type": _fuel(),
        "allocation_group": f"CASE WHEN p_size % 5 = 0 THEN 'nomap' ELSE {ALLOC} END",
        "exterior_color": "split_part(p_name, ' ', 1)",
        "loaner": "CASE WHEN l_tax = 0 THEN 'Y' END",
        "ex_service": "o_orderpriority",
        "status": "CASE l_returnflag WHEN 'A' THEN 's' WHEN 'N' THEN 'S' ELSE 'G' END",
        "inventory_count": "CASE WHEN l_linenumber = 7 THEN 0 ELSE 1 END",
        "balance": money(f"CASE WHEN l_linenumber <> 6 THEN {PRICE} - {PRICE} * {TAX} END"),
        "price_tier_93": money(f"CASE WHEN l_linenumber <> 2 THEN {PRICE} - {PRICE} * {DISC} END"),
        "price_tier_95": money(f"CASE WHEN l_linenumber <> 5 THEN {PRICE} - {QTY} END"),
        "price_tier_99": money(f"{PRICE} - {QTY} * 2"),
        "target_price": money(f"CASE WHEN l_linenumber <> 3 THEN {TARGET} END"),
        "msrp": money(PRICE),
        "msrp_adv": money(f"{PRICE} + {QTY}"),
        "internet_price": money(f"CASE WHEN l_linenumber <> 1 THEN {PRICE} - {QTY} END"),
        "days_in_inventory_group": f"CASE WHEN l_tax = 0.01 THEN NULL ELSE {d.days('l_shipdate', 'o_orderdate')} END",
        "days_in_inventory_store": d.days("l_shipdate", "o_orderdate"),
        "mileage": "CAST(l_quantity AS INT) * 1000",
        "original_source_code": d.pick(SOURCE_CODES, PRIORITY_NO),
        "source_type": d.pick(CURRENT_CODES, "l_linenumber"),
        "valid_for_group": "CASE WHEN l_tax = 0.08 THEN 0 ELSE 1 END",
        "valid_for_pricing": "CASE WHEN l_discount = 0.1 THEN 0 ELSE 1 END",
        "entry_date": "CAST(o_orderdate AS DATE)",
    }, LINE_STAR)
    roles["unit_snapshots"] = ({
        "snapshot_date": "CAST(l_shipdate AS DATE)",
        "vin": _unit(d),
        "store_name": "s_name",
        "store_id": "CAST(l_suppkey AS STRING)",
        "department": "CASE l_linestatus WHEN 'F' THEN '300' ELSE '320' END",
        "stock_type": "CASE l_linestatus WHEN 'F' THEN 'New' ELSE 'Used' END",
        "status": "CASE l_returnflag WHEN 'R' THEN 'G' ELSE 'S' END",
        "image_type": "CASE WHEN l_linenumber = 7 THEN 'StockPhotos' ELSE 'Real' END",
        "original_source_code": d.pick(SOURCE_CODES, PRIORITY_NO),
        "source_code": d.pick(CURRENT_CODES, "8 - l_linenumber"),
        "valid_for_group": "CASE WHEN l_tax = 0.08 THEN 0 ELSE 1 END",
        "price_tier_93": money(f"CASE WHEN l_linenumber <> 2 THEN {PRICE} - {PRICE} * {DISC} END"),
        "balance": money(f"{PRICE} - {PRICE} * {TAX}"),
        "target_price": money(f"CASE WHEN l_linenumber <> 3 THEN {TARGET} END"),
        "original_acv": money(f"{PRICE} - {QTY} * 100"),
        "days_in_inventory_group": f"CASE WHEN l_tax = 0.01 THEN NULL ELSE {d.days('l_shipdate', 'o_orderdate')} END",
    }, LINE_STAR[:4])
    roles["inventory_daily"] = ({
        "snapshot_date": "CAST(ts AS DATE)",
        "event_id": "event_id",
        "vin": "concat('U', CAST(user_id AS STRING))",
        "store_name": "event_type",
        "store_id": "event_type",
        "market_name": "CASE user_id % 10 WHEN 0 THEN 'market 97' ELSE concat('market ', CAST(user_id % 10 AS STRING)) END",
        "region_name": "CASE WHEN user_id % 9 = 0 THEN 'Corporate Management' ELSE 'Region 1' END",
        "department": "CASE WHEN user_id % 5 = 4 THEN '300' ELSE '320' END",
        "stock_type": "CASE WHEN user_id % 2 = 0 THEN 'NEW' ELSE 'used' END",
        "status": f"CASE WHEN {K} % 11 = 0 THEN 'G' ELSE 's' END",
        "year": f"2018 + {K} % 8",
        "make": event_make,
        "model": "event_type",
        "trim": f"CASE WHEN {K} % 4 = 0 THEN NULL ELSE concat('T', CAST({K} % 4 AS STRING)) END",
        "style_id": f"CASE WHEN {K} % 6 = 0 THEN NULL ELSE {K} END",
        "style_name": "concat('style ', event_type)",
        "mileage": f"{K} * 100",
        "days_in_inventory": f"{K}",
        "days_in_inventory_group": f"{K} + 2",
        "internet_price": f"CASE WHEN value < 0.5 THEN NULL ELSE {event_price} END",
        "balance": f"CAST({event_price} * CAST(0.9 AS DECIMAL(4,2)) AS DECIMAL(18,4))",
        "target_price": f"CASE WHEN {K} % 7 = 0 THEN NULL ELSE {event_price} END",
        "original_acv": f"CAST({event_price} * CAST(0.8 AS DECIMAL(4,2)) + {K} * 20 AS DECIMAL(18,4))",
        "price_tier_93": f"CASE WHEN {K} % 5 = 0 THEN NULL ELSE CAST({event_price} - {K} * 10 AS DECIMAL(18,4)) END",
        "price_tier_95": f"CASE WHEN {K} % 8 = 0 THEN CAST(0 AS DECIMAL(18,4)) WHEN {K} % 9 = 0 THEN NULL ELSE CAST({event_price} + 300 - {K} * 10 AS DECIMAL(18,4)) END",
        "msrp": f"CASE WHEN {K} % 13 = 0 THEN CAST(0 AS DECIMAL(18,4)) ELSE {event_price} END",
        "invoice_price": event_price,
        "great_price": f"CAST(3000 + {K} * 100 AS DECIMAL(18,4))",
        "good_price": f"CASE WHEN {K} % 10 = 0 THEN NULL ELSE CAST(4000 + {K} * 100 AS DECIMAL(18,4)) END",
        "fair_price": f"CAST(5000 + {K} * 100 AS DECIMAL(18,4))",
        "poor_price": f"CAST(9000 + {K} * 100 AS DECIMAL(18,4))",
        "original_source_code": d.pick(SOURCE_CODES, f"{K} % 5 + 1"),
        "source_code": d.pick(CURRENT_CODES, f"{K} % 7 + 1"),
        "vin_priced": "'Y'",
        "loaner": "CAST(NULL AS STRING)",
        "ex_service": "event_type",
        "valid_for_group": f"CASE WHEN {K} % 17 = 0 THEN 0 ELSE 1 END",
        "valid_for_pricing": "1",
    }, ["events"])
    order_status = ("CASE o_orderstatus WHEN 'F' THEN 'in transit' WHEN 'O' THEN (CASE WHEN o_orderpriority = '1-URGENT' "
                    "THEN 'NOT PRODUCED' ELSE 'BUILT' END) ELSE (CASE WHEN o_orderpriority = '5-LOW' THEN 'ignore' "
                    "ELSE 'TO BE BUILT' END) END")
    order_columns = {
        "order_number": "CAST(o_orderkey AS STRING)",
        "customer_no": "o_custkey",
        "status": order_status,
        "make": d.pick(MAKES, "o_custkey % 25 + 1"),
        "model": "o_orderpriority",
        "model_number": "CASE WHEN o_custkey % 20 = 0 THEN NULL ELSE concat('M', CAST(o_custkey % 60 AS STRING)) END",
        "model_year": "CAST(2019 + o_custkey % 7 AS INT)",
        "trim": "o_orderstatus",
        "alloc_group": "CASE o_orderpriority WHEN '1-URGENT' THEN 'nomap' WHEN '2-HIGH' THEN '' ELSE "
                       + "concat(" + d.pick(["ECONOMY", "SMALL", "MEDIUM", "PROMO", "STANDARD", "LARGE"], "o_custkey % 6 + 1")
                       + ", '-', CAST(o_custkey % 50 + 1 AS STRING)) END",
        "store_id": "CAST(o_custkey % 100 AS STRING)",
    }
    roles["orders_month"] = ({"time_period": d.year_month("o_orderdate"), **order_columns}, ["orders"])
    roles["orders_daily"] = ({"update_date": "CAST(o_orderdate AS DATE)", **order_columns}, ["orders"])
    entry = {
        "year": "CAST(year(o_orderdate) AS INT)",
        "month": "CAST(month(o_orderdate) AS INT)",
        "dealer_vehicle_id": "l_partkey",
        "mth": "CAST(month(o_orderdate) AS STRING)",
        "column_code": d.pick(PLAN_CODES, "CAST(l_quantity AS INT) % 15 + 1"),
        "entered_value": f"CASE WHEN l_linenumber = 7 THEN CAST(0 AS DECIMAL(12,2)) ELSE {QTY} END",
        "status_id": "l_linenumber",
        "flag": "l_returnflag",
        "line_status": "l_linestatus",
    }
    roles["plan_entries"] = (entry, LINE_STAR[:2])
    roles["vehicles"] = ({
        "dealer_vehicle_id": "p_partkey",
        "brand_id": "p_brand",
        "brand_model_id": "concat(p_brand, '|', p_type)",
        "dealer_code": "CAST(p_size % 10 AS STRING)",
        "brand_code": make,
        "brand_model_code": "p_type",
    }, ["part"])
    roles["stores"] = ({
        "store_id": "CAST(s_suppkey AS STRING)",
        "store_name": "s_name",
        "store_status": "CASE WHEN s_acctbal < 1000 THEN 'CLOSED' ELSE 'OPEN' END",
        "region_name": "r_name",
        "market_name": "n_name",
        "store_type": "'Store'",
        "manufacturer_name": d.pick(MAKER_NAMES, "s_suppkey % 25 + 1"),
        "store_eid": "s_suppkey",
        "market_eid": "n_nationkey",
        "region_eid": "r_regionkey",
        "manufacturer_key": "CAST(s_suppkey % 25 + 1 AS INT)",
        "zip": "concat(lpad(CAST(s_suppkey * 13 % 1000 AS STRING), 5, '0'), '-0001')",
        "acctbal": "s_acctbal",
    }, ["supplier", "nation:n_nationkey=s_nationkey", "region:r_regionkey=n_regionkey"])
    roles["manufacturers"] = ({
        "man_id": f"CAST({BRAND_NO} AS STRING)",
        "manufacturer_name": d.pick(MAKER_NAMES, BRAND_NO),
        "segment": f"CASE WHEN {BRAND_NO} <= 11 THEN 'Domestic' WHEN {BRAND_NO} <= 18 THEN 'Import' WHEN {BRAND_NO} <= 23 THEN 'Luxury' END",
        "dominant_brand": d.pick(DOMINANT, BRAND_NO),
        "manufacturer_group": "p_brand",
    }, ["part"])
    roles["leads"] = ({
        "lead_id": "event_id - event_id % 3",
        "activity_date": "CAST(ts AS DATE)",
        "store_eid": "user_id % 100",
        "provider_key": "event_type",
        "subprovider_key": f"{K} % 4",
        "lead_group": d.pick(LEAD_GROUPS, f"{K} % 6 + 1"),
        "cust_zip_code": "concat(lpad(CAST(user_id * 7 % 1200 AS STRING), 5, '0'), '1234')",
        "program_id": f"CASE WHEN {K} % 10 = 0 THEN NULL ELSE event_id END",
        "manager": "CAST(NULL AS STRING)",
        "associate_1": "concat('A', CAST(user_id % 40 AS STRING))",
        "associate_2": f"CASE WHEN {K} % 3 = 0 THEN concat('A', CAST({K} AS STRING)) END",
        "opportunities": "CAST(1 AS BIGINT)",
        "purchase_count": "CAST(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS BIGINT)",
        "vin": "concat('U', CAST(user_id AS STRING))",
    }, ["events"])
    roles["zips"] = ({
        "zip_code": "lpad(CAST(c_custkey % 100000 AS STRING), 5, '0')",
        "latitude": "25.0 + (c_custkey % 100000) * 0.0015",
        "longitude": "-80.0 - (c_custkey % 100000) * 0.0025",
    }, ["customer"])
    acquired_on = d.add_days("o_orderdate", "9131")
    roles["acquired"] = ({
        "acquisition_date": acquired_on,
        "trx_date": acquired_on,
        "vin": "concat('V', CAST(o_orderkey AS STRING))",
        "store_eid": "o_custkey % 100",
        "source_grouped": d.pick(ACQUISITION_SOURCES, PRIORITY_NO),
        "source_group_1": d.pick(ACQUISITION_SOURCES, PRIORITY_NO),
        "acquisition_count": "CAST(CASE WHEN o_orderstatus = 'O' THEN 0 ELSE 1 END AS BIGINT)",
        "sold_count": "CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS BIGINT)",
        "amount": "CAST(o_totalprice AS DECIMAL(18,4))",
        "lead_group": d.pick(LEAD_GROUPS, PRIORITY_NO),
    }, ["orders"])
    roles["photo_trend"] = ({
        "snapshot_date": "CAST(l_shipdate AS DATE)",
        "store_id": "CAST(l_suppkey AS STRING)",
        "vin": _unit(d),
        "entry_date": "CAST(o_orderdate AS DATE)",
        "photo_date": f"CASE WHEN l_linenumber = 6 THEN NULL ELSE {d.add_days('o_orderdate', 'CAST(l_quantity AS INT) - 5')} END",
    }, LINE_STAR[:2])
    roles["market_sales"] = ({
        "market_name": "n_name",
        "make": make,
        "site_code": "CAST(l_suppkey AS STRING)",
        "own_store": "CASE l_returnflag WHEN 'A' THEN concat('S', CAST(l_suppkey AS STRING)) WHEN 'N' THEN '' END",
        "selling_dealer": "CASE WHEN l_linenumber = 1 THEN '' ELSE concat('Dealer ', CAST(l_suppkey AS STRING)) END",
        "sale_year": "CAST(year(o_orderdate) AS INT)",
        "sale_month": "CAST(month(o_orderdate) AS INT)",
        "mtd_sales": "CAST(l_quantity AS BIGINT)",
    }, ["lineitem", "orders:o_orderkey=l_orderkey", "part:p_partkey=l_partkey", "customer:c_custkey=o_custkey",
        "nation:n_nationkey=c_nationkey"])
    roles["industry"] = ({
        "make": d.pick(INDUSTRY_CODES, BRAND_NO),
        "sale_year": "CAST(year(o_orderdate) AS INT)",
        "sale_month": "CAST(month(o_orderdate) AS INT)",
        "file_date": d.month("l_shipdate"),
        "sales": "CAST(l_quantity AS BIGINT)",
    }, LINE_STAR[:3])
    roles["customers"] = ({
        "cust_no": "CAST(c_custkey AS STRING)",
        "market_id": "lpad(CAST(c_nationkey AS STRING), 4, '0')",
        "first_name": "concat('First', CAST(c_custkey % 97 AS STRING))",
        "last_name": "concat('Last', CAST(c_custkey % 1013 AS STRING))",
        "email": "concat('c', CAST(c_custkey AS STRING), '@', lower(c_mktsegment), '.example')",
        "phone": "concat('555', lpad(CAST(c_custkey AS STRING), 7, '0'))",
    }, ["customer"])
    off = "CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END"
    roles["referral_form"] = ({
        "form_id": "o_orderkey",
        "market_id": "concat(lpad(CAST(c_nationkey AS STRING), 4, '0'), ' ', c_mktsegment)",
        "first_name": "CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'Nobody' ELSE concat('first', CAST(c_custkey % 97 AS STRING)) END",
        "last_name": "CASE WHEN o_orderpriority = '1-URGENT' THEN concat('La''st', CAST(c_custkey % 1013 AS STRING)) ELSE concat('Last', CAST(c_custkey % 1013 AS STRING)) END",
        "email": "CASE WHEN o_orderpriority = '3-MEDIUM' THEN '' ELSE concat('C', CAST(c_custkey AS STRING), '@', lower(c_mktsegment), '.example') END",
        "phone": f"CASE WHEN o_orderpriority = '2-HIGH' THEN NULL WHEN o_orderpriority = '5-LOW' THEN concat('(555) ', lpad(CAST(c_custkey + {off} AS STRING), 7, '0')) ELSE concat('(555) ', lpad(CAST(c_custkey AS STRING), 7, '0')) END",
        "submitter_email": "concat('s', CAST(o_orderkey AS STRING), '@staff.example')",
    }, ["orders", "customer:c_custkey=o_custkey"])
    roles["scorecard_rows"] = ({
        "month": "CAST(month(o_orderdate) AS INT)",
        "year": "CAST(year(o_orderdate) AS INT)",
        "store": "n_name",
        "brand": "r_name",
        "units": QTY,
        "gross": f"{PRICE} * {DISC}",
        "retail": PRICE,
    }, LINE_STAR[:2] + LINE_STAR[3:])
    roles["questions"] = ({
        "question_id": "o_orderkey",
        "question": "concat(" + d.pick(QUESTION_STARTS, f"(o_custkey + o_orderkey) % {len(QUESTION_STARTS)} + 1")
                    + ", ' ', " + d.pick(["retail units", "core pvr", "variable gross?", "gross figure", "nothing known"], "o_custkey % 5 + 1")
                    + ", ' ', CASE WHEN o_custkey % 3 = 0 THEN '' ELSE concat('at ', n_name, ' ') END, "
                    + "CASE WHEN o_custkey % 7 < 2 THEN concat('for ', r_name, ' ') ELSE '' END, "
                    + "CASE WHEN o_custkey % 4 = 0 THEN '' ELSE concat('in ', " + d.month_name("o_orderdate") + ", ' ') END, "
                    + "CASE WHEN o_custkey % 2 = 0 THEN '' ELSE CAST(year(o_orderdate) AS STRING) END)",
    }, ["orders", "customer:c_custkey=o_custkey", "nation:n_nationkey=c_nationkey", "region:r_regionkey=n_regionkey"])
    record = ("concat('{{\"id\":\"', CAST(s_suppkey AS STRING), '\",\"name\":\"', s_name, '{suffix}\",\"lat\":', "
              "CAST(s_nationkey AS STRING), ',\"city\":\"', n_name, '\",\"state\":\"', r_name, '\"}}')")
    card = ("concat('<div><h3 class=\"name\">', s_name, ' &amp; Sons</h3><i>x</i>', "
            "CASE WHEN s_acctbal < 2000 THEN '' ELSE concat('<p class=\"addr\">', n_name, ' Street<br>', r_name, '</p>') END, '</div>')")
    popup = ("concat('locations.push([ ''<div class=\"map-popup\"><h3>', s_name, '</h3><p class=\"address\">', "
             "CAST(s_suppkey AS STRING), ' Main St, Suite 1<br/>', n_name, ', ', r_name, ' 12345</p></div>'', 1]);')")
    roles["location_pages"] = ({
        "page_id": "s_suppkey",
        "html": "concat('<html>', " + record.format(suffix="") + ", ' text ', " + record.format(suffix=" East") + ", "
                + card + ", " + card.replace("s_name", "n_name") + ", " + popup + ", '</html>')",
        "s_name": "s_name", "n_name": "n_name", "r_name": "r_name", "acctbal": "s_acctbal",
    }, ["supplier", "nation:n_nationkey=s_nationkey", "region:r_regionkey=n_regionkey"])
    return roles


# Roles that are distinct or filtered selections of a role above: (base, distinct columns, filter).
DERIVED = {
    "commits": ("plan_entries", None, "flag <> 'R'"),
    "forecasts": ("plan_entries", None, "flag <> 'A'"),
    "brands": ("vehicles", ["brand_id", "brand_code"], "brand_code IS NOT NULL"),
    "models": ("vehicles", ["brand_model_id", "brand_id", "brand_model_code"], None),
    "dealers": ("vehicles", ["dealer_code"], "dealer_code <> '9'"),
    "cores": ("plan_entries", ["dealer_vehicle_id", "year", "month"], "line_status = 'F'"),
    "sorts": ("vehicles", ["brand_model_id"], "brand_model_code <> 'PROMO'"),
    "makers": ("manufacturers", ["man_id", "manufacturer_name", "segment", "dominant_brand", "manufacturer_group"], None),
    "zip_points": ("zips", ["zip_code", "latitude", "longitude"], None),
    "sales_current": ("market_sales", None, "sale_year >= 1999"),
    "sales_history": ("market_sales", None, "sale_year <= 1998 OR (sale_year = 1999 AND sale_month IN (6, 7))"),
    "allowed_pairs": ("market_sales", ["market_name", "make"], "mtd_sales >= 49 AND make <> 'KIA'"),
    "inventory_live": ("unit_snapshots", None, "status = 'S'"),
}


# Explicit schemas: no read has to look into a file before it is planned.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


_FRAMES: dict[tuple[int, str, str], DataFrame] = {}


def forget() -> None:
    """Every query lists and analyses its files anew, as a user's first call does."""
    _FRAMES.clear()


def _remembered(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """Analysed frames of one query, so that a role is analysed once and not per use."""
    key = (id(spark), sf_dir, name)
    if key not in _FRAMES or _FRAMES[key].sparkSession is not spark:
        _FRAMES[key] = build()
    return _FRAMES[key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return _remembered(spark, sf_dir, f"table {name}", lambda: _read(spark, sf_dir, name))


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir}/{name}.parquet")


@lru_cache(maxsize=1)
def _spark_definitions():
    return definitions(SPARK)


def frame(spark: SparkSession, sf_dir: str, role: str, wanted: str = "") -> DataFrame:
    """A role as a DataFrame, with all columns or the ``wanted`` ones.

    A table is only joined when a wanted column needs it: every foreign key of the driver's
    tables has exactly one match, so leaving the join out changes no row.
    """
    return _remembered(spark, sf_dir, f"{role} {wanted}", lambda: _build(spark, sf_dir, role, wanted.split()))


def _build(spark: SparkSession, sf_dir: str, role: str, wanted: list[str]) -> DataFrame:
    if role in DERIVED:
        base, distinct, condition = DERIVED[role]
        chosen = wanted or distinct or []
        tested = [c for c in _spark_definitions()[base][0] if condition and re.search(rf"\b{c}\b", condition)]
        df = frame(spark, sf_dir, base, " ".join(dict.fromkeys([*chosen, *tested])) if chosen else "")
        if condition:
            df = df.filter(condition)
        if chosen:
            df = df.select(*chosen)
        return df.distinct() if distinct else df
    columns, tables = _spark_definitions()[role]
    if wanted:
        columns = {name: columns[name] for name in wanted}
        tables = _needed(columns.values(), tables)
    df = table(spark, sf_dir, tables[0])
    for joined in tables[1:]:
        name, keys = joined.split(":")
        right, left = keys.split("=")
        df = df.join(table(spark, sf_dir, name), F.col(left) == F.col(right))
    return df.selectExpr(*[f"{expr} AS {name}" for name, expr in columns.items()])


def _needed(expressions, tables: list[str]) -> list[str]:
    """The first table, the tables whose columns are used, and those they are joined through."""
    by_prefix = {name.split(":")[0][0]: name for name in tables}
    used = {p for expr in expressions for p in re.findall(r"\b([a-z])_[a-z]", expr) if p in by_prefix}
    for joined in reversed(tables[1:]):
        if joined[0] in used:
            used.add(joined.split("=")[1][0])
    return [tables[0], *[t for t in tables[1:] if t[0] in used]]


def views(*names: str) -> str:
    """``WITH`` clause of the oracle defining the roles named, ready for more CTEs."""
    wanted: list[str] = []
    for name in names:
        if name in DERIVED and DERIVED[name][0] not in wanted:
            wanted.append(DERIVED[name][0])
        if name not in wanted:
            wanted.append(name)
    parts = []
    all_definitions = definitions(DUCK)
    for name in wanted:
        if name in DERIVED:
            base, distinct, condition = DERIVED[name]
            what = "DISTINCT " + ", ".join(distinct) if distinct else "*"
            parts.append(f"{name} AS (SELECT {what} FROM {base}" + (f" WHERE {condition}" if condition else "") + ")")
            continue
        columns, tables = all_definitions[name]
        source = tables[0]
        for joined in tables[1:]:
            right, keys = joined.split(":")
            source += f" JOIN {right} ON {keys}"
        parts.append(f"{name} AS (SELECT " + ", ".join(f"{e} AS {c}" for c, e in columns.items()) + f" FROM {source})")
    return "WITH " + ",\n".join(parts)


# --- output schemas -----------------------------------------------------------

_CASTS = {"s": "string", "i": "bigint", "d": "double", "t": "date", "b": "boolean", "r": "double"}


def _columns(spec: str) -> list[tuple[str, str]]:
    return [tuple(item.rsplit(":", 1)) if ":" in item else (item, "s") for item in spec.split()]


def finish(df: DataFrame, spec: str) -> DataFrame:
    """Final column choice and types: ``name:type`` with s(tring), i(nteger), d(ouble),
    r(ounded double), (da)t(e), b(oolean)."""
    out = []
    for name, kind in _columns(spec):
        col = F.col(name).cast(_CASTS[kind])
        out.append((F.round(col, 6) if kind == "r" else col).alias(name))
    return df.select(*out)


def oracle(with_clause: str, query: str, spec: str, more: str = "") -> str:
    """Oracle SQL with the same final column choice and types."""
    casts = []
    for name, kind in _columns(spec):
        expr = f"CAST({name} AS {_CASTS[kind].upper()})"
        casts.append((f"round({expr}, 6)" if kind == "r" else expr) + f" AS {name}")
    head = with_clause + (",\n" + more if more else "") if with_clause else ("WITH " + more if more else "")
    joiner = ", " if head else "WITH "
    return f"{head}{joiner}_result AS (\n{query}\n)\nSELECT {', '.join(casts)} FROM _result"
