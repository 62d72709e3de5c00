"""Column schemas of the input roles; readers apply them instead of inferring."""

MONEY = "decimal(19,4)"

INVENTORY_MONTH = f"""
accounting_month date, region_name string, market_name string, store_name string, store_id string,
department string, vin string, year int, make string, model string, model_id string, trim string,
style_id int, style_name string, fuel_type string, allocation_group string, exterior_color string,
loaner string, ex_service string, status string, inventory_count int, balance {MONEY},
price_tier_93 {MONEY}, price_tier_95 {MONEY}, price_tier_99 {MONEY}, target_price {MONEY}, msrp {MONEY},
msrp_adv {MONEY}, internet_price {MONEY}, days_in_inventory_group int, days_in_inventory_store int,
mileage int, original_source_code string, source_type string, valid_for_group int, valid_for_pricing int,
entry_date date"""

INVENTORY_DAILY = f"""
snapshot_date date, vin string, store_name string, market_name string, region_name string, store_id string,
department string, stock_type string, status string, image_type string, year int, make string, model string,
trim string, style_name string, style_id int, mileage int, days_in_inventory int, days_in_inventory_group int,
internet_price {MONEY}, balance {MONEY}, target_price {MONEY}, original_acv {MONEY}, price_tier_93 {MONEY},
price_tier_95 {MONEY}, msrp {MONEY}, invoice_price {MONEY}, great_price {MONEY}, good_price {MONEY},
fair_price {MONEY}, poor_price {MONEY}, original_source_code string, source_code string, source_name string,
vin_priced string, loaner string, ex_service string, valid_for_group int, valid_for_pricing int"""

SALES_DETAIL = f"""
accounting_month date, accounting_date date, contract_date date, store_id string, store_name string,
market_name string, region_name string, department string, record_source string, sale_type string, vin string,
trade_vin string, make string, model string, trim string, style_name string, fuel_type string,
allocation_group string, model_year int, mileage int, sold_count int, interco_count int, auction_count int,
fi_count int, front_gross {MONEY}, base_retail {MONEY}, incentives {MONEY}, fi_gross {MONEY}, ovi {MONEY},
total_gross {MONEY}, interco_gross {MONEY}, auction_gross {MONEY}, front_revenue {MONEY},
interco_revenue {MONEY}, auction_revenue {MONEY}, front_cos {MONEY}, cash_price {MONEY}, target_price {MONEY},
invoice_price {MONEY}, msrp_adv {MONEY}, recon_cost {MONEY}, non_ro_amount {MONEY}, vehicle_age int,
vehicle_age_group int, source_type string, original_source_code string, source_name string, cust_no string,
deal_no string, ex_service string"""

ORDERS_MONTH = "time_period string, order_number string, status string, make string, model string, " \
    "model_number string, model_year int, trim string, alloc_group string, store_id string"
ORDERS_DAILY = ORDERS_MONTH.replace("time_period string", "update_date date")

PLAN_ENTRIES = "year int, month int, dealer_vehicle_id bigint, mth string, column_code string, " \
    f"entered_value {MONEY}, status_id int"

PHOTO_TREND = "snapshot_date date, store_id string, vin string, entry_date date, photo_date date"

MARKET_SALES = "dma_code string, market_name string, own_store string, dealer_id string, site_code string, " \
    "selling_dealer string, selling_dealer_city string, selling_dealer_state string, make string, " \
    "sale_year int, sale_month int, mtd_sales bigint, file_date date"

INDUSTRY_MAKE = "make string, sale_year int, sale_month int, file_date date, sales bigint"

ENTITIES = "entity_id string, parent_id string, store_id string, entity_name string, entity_type string, " \
    "status string, manufacturer_code string, city string, state string"

ROLES = {
    "inventory_month": INVENTORY_MONTH, "inventory_daily": INVENTORY_DAILY, "inventory_live": INVENTORY_DAILY,
    "sales_detail": SALES_DETAIL, "orders_month": ORDERS_MONTH, "orders_daily": ORDERS_DAILY, "commits": PLAN_ENTRIES,
    "forecasts": PLAN_ENTRIES, "photo_trend": PHOTO_TREND, "market_sales_current": MARKET_SALES,
    "market_sales_history": MARKET_SALES, "industry_make": INDUSTRY_MAKE, "entities": ENTITIES,
}
