"""SQL building blocks: the star as common table expressions over the source tables."""

from __future__ import annotations

from shelfline.schemas import TABLES

import re

KEY60 = "CAST(('0x' || substr(md5({}), 1, 15)) AS BIGINT)"


def key60(*parts: str) -> str:
    return KEY60.format(f"concat_ws('|', {', '.join(parts)})")


def date_sk(day: str) -> str:
    return f"CAST(year({day}) * 10000 + month({day}) * 100 + day({day}) AS INTEGER)"


def pick(values, number: str) -> str:
    """The value at number modulo length."""
    cells = ["NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v) for v in values]
    return f"([{', '.join(cells)}])[CAST(({number}) % {len(cells)} AS INTEGER) + 1]"


def pad(number: str, width: int) -> str:
    return f"lpad(CAST({number} AS VARCHAR), {width}, '0')"


def title(code: str) -> str:
    """FULL_LINE as Full Line, for codes of one to three words."""
    return f"array_to_string([upper(w[1]) || lower(w[2:]) for w in string_split({code}, '_')], ' ')"


REASONS = ("SIZE", "FIT", "DEFECT", "COLOR", "QUALITY", "CHANGED_MIND", "DAMAGED", "LATE_DELIVERY")
REASON_TEXTS = (
    "Wrong Size", "Poor Fit", "Product Defect", "Color Mismatch", "Quality Issues", "Changed Mind",
    "Received Damaged", "Late Delivery",
)

CALENDAR_BODY = """
SELECT d AS full_date,
  {sk} AS date_sk,
  CAST(dayofweek(d) + 1 AS TINYINT) AS day_of_week_num,
  dayname(d) AS day_of_week_name, substr(dayname(d), 1, 3) AS day_of_week_abbr,
  CAST(day(d) AS TINYINT) AS day_of_month, CAST(dayofyear(d) AS SMALLINT) AS day_of_year,
  CAST(weekofyear(d) AS TINYINT) AS week_of_year, CAST(weekofyear(d) AS TINYINT) AS iso_week_number,
  CAST(month(d) AS TINYINT) AS month_num, monthname(d) AS month_name, substr(monthname(d), 1, 3) AS month_abbr,
  substr(monthname(d), 1, 3) || '-' || year(d) AS month_year,
  CAST(quarter(d) AS TINYINT) AS quarter_num, 'Q' || quarter(d) || '-' || year(d) AS quarter_name,
  CAST(year(d) AS SMALLINT) AS year_num,
  CAST(date_trunc('month', d) AS DATE) AS first_day_of_month, last_day(d) AS last_day_of_month,
  CAST(date_trunc('quarter', d) AS DATE) AS first_day_of_quarter,
  CAST(date_trunc('quarter', d) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS last_day_of_quarter,
  CAST((((month(d) + 6) % 12)) * 4 + (day(d) - 1) // 7 + 1 AS TINYINT) AS fiscal_week_num,
  CAST((month(d) + 6) % 12 + 1 AS TINYINT) AS fiscal_month_num,
  CAST(((month(d) + 6) % 12) // 3 + 1 AS TINYINT) AS fiscal_quarter_num,
  CAST(CASE WHEN month(d) > 5 THEN year(d) + 1 ELSE year(d) END AS SMALLINT) AS fiscal_year_num,
  'FQ' || (((month(d) + 6) % 12) // 3 + 1) || '-FY' || (CASE WHEN month(d) > 5 THEN year(d) + 1 ELSE year(d) END)
    AS fiscal_quarter_name,
  CAST(((dayofyear(d) - 1) // 7) // 4 + 1 AS TINYINT) AS retail_period_num,
  CAST((dayofyear(d) - 1) // 7 + 1 AS SMALLINT) AS retail_week_num,
  CAST(CASE WHEN month(d) = 1 THEN year(d) - 1 ELSE year(d) END AS SMALLINT) AS retail_year_num,
  dayofweek(d) BETWEEN 1 AND 5 AS is_weekday, dayofweek(d) IN (0, 6) AS is_weekend,
  holiday IS NOT NULL AS is_holiday, holiday AS holiday_name,
  d = thx + 1 AS is_black_friday, d = thx + 4 AS is_cyber_monday,
  month(d) IN (7, 8) AND day(d) >= 15 AS is_back_to_school,
  CASE WHEN month(d) IN (3, 4, 5) THEN 'SPRING' WHEN month(d) IN (6, 7, 8) THEN 'SUMMER'
       WHEN month(d) IN (9, 10, 11) THEN 'FALL' ELSE 'HOLIDAY' END AS season
FROM (
  SELECT d, thx, CASE WHEN d = thx THEN 'Thanksgiving' WHEN d = thx + 1 THEN 'Black Friday'
    WHEN d = thx + 4 THEN 'Cyber Monday' WHEN month(d) = 1 AND day(d) = 1 THEN 'New Year Day'
    WHEN month(d) = 7 AND day(d) = 4 THEN 'Independence Day' WHEN month(d) = 12 AND day(d) = 25 THEN 'Christmas Day'
    WHEN month(d) = 12 AND day(d) = 26 THEN 'Boxing Day' END AS holiday
  FROM (SELECT d, CAST(make_date(year(d), 11, 1)
      + CAST((11 - dayofweek(make_date(year(d), 11, 1))) % 7 + 21 AS INTEGER) AS DATE) AS thx FROM {days})
)
""".replace("{sk}", date_sk("d"))


def calendar_sql(days: str) -> str:
    """All calendar attributes of a table with a date column d."""
    return CALENDAR_BODY.replace("{days}", days)


CTES = {
    "c_span": """
SELECT CAST(date_trunc('year', first_order) AS DATE) AS first_day, CAST(last_order AS DATE) AS horizon,
  make_date(year(greatest(last_order, last_shipped)), 12, 31) AS last_day
FROM (SELECT min(o_orderdate) AS first_order, max(o_orderdate) AS last_order FROM orders),
  (SELECT max(l_shipdate) AS last_shipped FROM lineitem)""",
    "c_days": """
SELECT CAST(unnest(generate_series(CAST(first_day AS TIMESTAMP), CAST(last_day AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d
FROM c_span""",
    "c_dates": calendar_sql("c_days"),
    "c_places": """
SELECT n_nationkey, 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS country_code, n_name AS country_name,
  CASE r_name WHEN 'AMERICA' THEN 'AMER' WHEN 'ASIA' THEN 'APAC' ELSE 'EMEA' END AS region_code, r_name AS region_name
FROM nation LEFT JOIN region ON n_regionkey = r_regionkey""",
    "c_rawstores": f"""
SELECT s_suppkey AS store_sk, s_name AS base_name,
  {pick(("ECOM", "PARTNER", "CONCEPT", "FLAGSHIP", "FACTORY"), "s_suppkey")} AS store_type,
  {pick(("DIGITAL", "FULL_LINE", "SPORT", "RUN", "BASKETBALL"), "s_suppkey")} AS store_format,
  {pick(("ECOMMERCE", "WHOLESALE", "WHOLESALE", "BRICK_MORTAR", "BRICK_MORTAR"), "s_suppkey")} AS channel_type,
  region_code, region_name, country_code, country_name,
  country_code || '-S' || (s_suppkey % 3) AS state_code, 'City ' || country_code || '-' || (s_suppkey % 6) AS city
FROM supplier LEFT JOIN c_places ON s_nationkey = n_nationkey""",
    "c_stores": f"""
SELECT store_sk, 'STR-' || country_code || '-' || {pad("store_sk", 5)} AS store_nk,
  base_name || ' ' || city || ' ' || CASE WHEN store_type = 'ECOM' THEN 'Online' ELSE {title("store_format")} END AS store_name,
  store_type, region_code, region_name, country_code, country_name, state_code AS state_province_code,
  state_code AS state_province_name, city AS metro_market, city,
  (store_sk % 9900 + 100) || ' Main Street' AS store_address, CAST(store_sk % 90000 + 10000 AS VARCHAR) AS postal_code,
  CAST(store_sk % 25 + 25 AS DECIMAL(10,7)) AS latitude, CAST(store_sk % 55 - 125 AS DECIMAL(10,7)) AS longitude,
  CASE WHEN store_type <> 'ECOM' THEN CAST(store_sk % 23000 + 2000 AS INTEGER) END AS square_footage,
  CASE WHEN store_type <> 'ECOM' THEN CAST(store_sk % 3 + 1 AS SMALLINT) END AS num_floors,
  store_format, channel_type, store_type = 'ECOM' AS is_digital,
  {date_sk("((SELECT first_day FROM c_span) - CAST(store_sk % 3285 + 365 AS INTEGER))")} AS open_date_sk,
  CAST(NULL AS INTEGER) AS close_date_sk, TRUE AS is_active,
  CASE WHEN store_type IN ('FLAGSHIP', 'FACTORY', 'ECOM') THEN 'OWNED'
    ELSE {pick(("FRANCHISE", "PARTNER"), "store_sk")} END AS ownership_model,
  CASE WHEN store_type NOT IN ('FLAGSHIP', 'FACTORY', 'ECOM') THEN 'PTR-' || (store_sk % 9000 + 1000) END AS partner_account_id
FROM c_rawstores""",
    "c_rawproducts": """
SELECT p_partkey AS product_sk, p_brand, p_type,
  CASE WHEN p_type IN ('SMALL', 'MEDIUM') THEN 'FW' WHEN p_type IN ('LARGE', 'STANDARD') THEN 'AP' ELSE 'EQ' END AS kind,
  p_type AS division_name, p_brand AS category_name, 'Size ' || p_size AS subcategory_name,
  string_split(p_name, ' ')[2] AS product_line_name,
  string_split(p_name, ' ')[1] || '/' || lower(p_type) AS colorway,
  CAST(p_retailprice AS DECIMAL(12,2)) AS base_price, p_partkey % 16 + 35 AS cost_percent,
  p_partkey % 10 = 0 AS is_hero
FROM part""",
    "c_prices": """
SELECT *, CAST(unit_retail_price * CAST(cost_percent AS DECIMAL(3,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(12,4)) AS unit_cost_price
FROM (SELECT *, CASE WHEN is_hero THEN CAST(base_price * CAST(1.3 AS DECIMAL(2,1)) AS DECIMAL(12,4))
    ELSE CAST(base_price AS DECIMAL(12,4)) END AS unit_retail_price FROM c_rawproducts)""",
    "c_products": f"""
SELECT product_sk, 'SKU-' || kind || '-' || {pad("product_sk", 6)} AS product_nk, {pad("product_sk", 12)} AS upc_code,
  upper(substr(division_name, 1, 3)) AS division_code, division_name,
  upper(substr(category_name, 1, 3)) AS category_code, category_name,
  upper(substr(subcategory_name, 1, 3)) AS subcategory_code, subcategory_name,
  upper(substr(product_line_name, 1, 3)) AS product_line_code, product_line_name,
  product_line_name || ' ' || string_split(colorway, '/')[1] AS product_name,
  product_line_name || ' ' || category_name || ' ' || subcategory_name AS product_description,
  'STY-' || {pad("product_sk", 6)} AS style_code, colorway,
  CASE kind WHEN 'FW' THEN {pick(("US6", "US6.5", "US7", "US7.5", "US8", "US8.5", "US9", "US9.5", "US10", "US10.5", "US11", "US11.5", "US12", "US13", "US14"), "product_sk")}
    WHEN 'AP' THEN {pick(("XS", "S", "M", "L", "XL", "XXL", "3XL"), "product_sk")}
    ELSE {pick(("One Size", "S/M", "M/L", "L/XL"), "product_sk")} END AS size,
  {pick(("MENS", "WOMENS", "UNISEX", "KIDS"), "product_sk")} AS gender_target,
  CASE WHEN product_sk % 4 = 3 THEN {pick(("YOUTH", "TODDLER"), "product_sk // 4")} ELSE 'ADULT' END AS age_group,
  CASE WHEN kind = 'EQ' THEN 'Mixed Materials' ELSE 'Synthetic/Textile' END AS material_composition,
  CAST(NULL AS VARCHAR) AS technology_features,
  category_name AS sport_occasion, is_hero AS is_hero_product, product_sk % 20 = 1 AS is_exclusive,
  product_sk % 33 = 2 AS is_collaboration, unit_cost_price AS standard_cost, unit_retail_price AS standard_retail_price,
  {date_sk("((SELECT first_day FROM c_span) - CAST(product_sk % 1500 AS INTEGER))")} AS launch_date_sk,
  CAST(NULL AS INTEGER) AS discontinue_date_sk, TRUE AS is_active,
  (SELECT first_day FROM c_span) - CAST(product_sk % 1500 AS INTEGER) AS effective_date, DATE '9999-12-31' AS expiry_date,
  TRUE AS is_current_flag
FROM c_prices""",
    "c_tiers": """
SELECT c_custkey AS customer_sk, c_mktsegment AS customer_segment, country_code,
  country_code || '-S' || (c_custkey % 3) AS state_province, 'City ' || country_code || '-' || (c_custkey % 6) AS city,
  c_custkey % 20 < 13 AS loyalty_member_flag, c_custkey * 104729 % 100 AS ltv_draw,
  CASE WHEN c_custkey % 20 < 13 THEN CASE WHEN c_custkey * 7919 % 100 < 50 THEN 'Bronze' WHEN c_custkey * 7919 % 100 < 80 THEN 'Silver'
    WHEN c_custkey * 7919 % 100 < 95 THEN 'Gold' ELSE 'Elite' END END AS loyalty_tier
FROM customer LEFT JOIN c_places ON c_nationkey = n_nationkey""",
    "c_bands": """
SELECT *, CASE loyalty_tier
  WHEN 'Elite' THEN CASE WHEN ltv_draw < 10 THEN 'Mid' WHEN ltv_draw < 40 THEN 'High' ELSE 'VIP' END
  WHEN 'Gold' THEN CASE WHEN ltv_draw < 5 THEN 'Low' WHEN ltv_draw < 30 THEN 'Mid' WHEN ltv_draw < 80 THEN 'High' ELSE 'VIP' END
  WHEN 'Silver' THEN CASE WHEN ltv_draw < 15 THEN 'Low' WHEN ltv_draw < 60 THEN 'Mid' WHEN ltv_draw < 90 THEN 'High' ELSE 'VIP' END
  ELSE CASE WHEN ltv_draw < 40 THEN 'Low' WHEN ltv_draw < 80 THEN 'Mid' WHEN ltv_draw < 95 THEN 'High' ELSE 'VIP' END
  END AS lifetime_value_band
FROM c_tiers""",
    "c_customers": f"""
SELECT customer_sk, 'CRM-' || upper(substr(md5(CAST(customer_sk AS VARCHAR)), 1, 8)) AS customer_nk,
  'FirstName' || customer_sk AS first_name, 'LastName' || customer_sk AS last_name,
  sha256('customer' || customer_sk || '@email.com') AS email_address_hash,
  sha256('+1' || lpad(CAST(customer_sk AS VARCHAR), 10, '5')) AS phone_hash,
  {date_sk("(DATE '1960-01-01' + CAST(customer_sk * 37 % 16400 AS INTEGER))")} AS date_of_birth_sk,
  CASE WHEN customer_sk % 25 < 12 THEN 'M' WHEN customer_sk % 25 < 24 THEN 'F'
    ELSE {pick(("N", "U"), "customer_sk")} END AS gender_code,
  loyalty_member_flag, loyalty_tier,
  CAST(CASE WHEN loyalty_member_flag THEN customer_sk * 97 % 50000 ELSE 0 END AS INTEGER) AS loyalty_points_balance,
  CASE WHEN loyalty_member_flag THEN {date_sk("((SELECT first_day FROM c_span) - CAST(customer_sk % 1470 + 30 AS INTEGER))")} END
    AS loyalty_enroll_date_sk,
  customer_segment, {pick(("Running", "Basketball", "Training", "Soccer", "Golf", "Lifestyle"), "customer_sk")} AS preferred_sport,
  lifetime_value_band,
  {pick(("Organic Search", "Paid Search", "Social Media", "Email", "Referral", "Direct", "Affiliate"), "customer_sk")}
    AS acquisition_channel,
  city, state_province, country_code, CAST(customer_sk % 90000 + 10000 AS VARCHAR) AS postal_code,
  (SELECT first_day FROM c_span) - CAST(customer_sk % 730 AS INTEGER) AS effective_date, DATE '9999-12-31' AS expiry_date,
  TRUE AS is_current_flag,
  sha256(coalesce(loyalty_tier, '') || '|' || customer_segment || '|' || lifetime_value_band || '|' || city || '|'
    || state_province || '|' || country_code) AS record_checksum
FROM c_bands""",
    "c_employees": f"""
SELECT employee_sk, 'EMP-' || {pad("employee_sk", 6)} AS employee_nk, sha256('Employee_' || employee_sk) AS full_name_hash,
  {pick(("Sales Associate", "Senior Sales Associate", "Floor Manager", "Assistant Store Manager", "Store Manager", "District Manager", "Visual Merchandiser", "Stock Associate", "Cashier"), "employee_sk")} AS job_title,
  {pick(("Sales", "Operations", "Management", "Merchandising", "Inventory"), "employee_sk")} AS department,
  store_sk, {date_sk("hired")} AS hire_date_sk,
  CASE WHEN employee_sk * 31 % 19 = 0 THEN {date_sk("(hired + CAST(employee_sk % 1320 + 180 AS INTEGER))")} END AS termination_date_sk,
  employee_sk * 31 % 19 <> 0 AS is_active, hired AS effective_date, DATE '9999-12-31' AS expiry_date, TRUE AS is_current_flag
FROM (SELECT *, (SELECT first_day FROM c_span) - CAST(employee_sk % 1970 + 30 AS INTEGER) AS hired
  FROM (SELECT store_sk, store_sk * 100 + unnest(range(1, store_sk % 11 + 6)) AS employee_sk FROM c_stores WHERE NOT is_digital))""",
    "c_promotions": f"""
SELECT *, CASE WHEN end_date >= (SELECT horizon FROM c_span) THEN 'ACTIVE' ELSE 'COMPLETED' END AS promotion_status,
  {date_sk("start_date")} AS start_date_sk, {date_sk("end_date")} AS end_date_sk,
  CAST(CASE discount_type WHEN 'PERCENT' THEN {pick((10, 15, 20, 25, 30, 40, 50), "promotion_sk")}
    WHEN 'FIXED_AMOUNT' THEN {pick((5, 10, 15, 20, 25, 50), "promotion_sk")} ELSE 0 END AS DECIMAL(8,4)) AS discount_value
FROM (SELECT *, least(start_date + CAST(promotion_sk % 38 + 7 AS INTEGER), (SELECT horizon FROM c_span)) AS end_date,
    {pick(("PERCENT", "FIXED_AMOUNT", "FREE_GIFT"), "promotion_sk")} AS discount_type
  FROM (SELECT item_sk AS promotion_sk, p_brand, (SELECT first_day FROM c_span) + CAST(item_sk * 16 AS INTEGER) AS start_date
    FROM (SELECT DISTINCT item_sk, p_brand FROM c_parts)))""",
    "c_parts": """
SELECT *, (CAST(string_split(p_brand, '#')[2] AS BIGINT) - 1) * 6
  + list_position(['ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD'], p_type) AS item_sk
FROM part""",
    "c_lines": f"""
SELECT {key60("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "CAST(round(l_extendedprice * 100) AS BIGINT)")} AS transaction_sk,
  CAST(l_orderkey AS VARCHAR) AS transaction_id, l_linenumber AS line_number,
  CAST(o_orderdate AS DATE) AS transaction_date, {date_sk("o_orderdate")} AS transaction_date_sk,
  CAST(date_trunc('year', o_orderdate) AS DATE) AS transaction_year,
  CASE WHEN o_custkey % 5 <> 0 THEN o_custkey END AS customer_sk, l_partkey AS product_sk, l_suppkey AS store_sk,
  CAST(CASE WHEN l_suppkey % 5 = 0 THEN 2 + l_orderkey % 3 WHEN l_suppkey % 5 IN (1, 2) THEN 6 + l_orderkey % 3
    WHEN l_orderkey % 2 = 0 THEN 1 ELSE 5 END AS INTEGER) AS channel_sk,
  CASE WHEN l_orderkey % 10 < 3 THEN 1 + l_orderkey % 150 END AS promotion_sk,
  CASE WHEN l_suppkey % 5 <> 0 THEN l_suppkey * 100 + 1 + l_orderkey % (l_suppkey % 11 + 5) END AS employee_sk,
  CAST(l_quantity AS DECIMAL(6,0)) AS quantity_sold, CAST(l_discount AS DECIMAL(4,2)) AS discount_rate,
  CAST(l_tax AS DECIMAL(4,2)) AS tax_rate, CASE WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END AS return_flag,
  l_orderkey AS order_number, CAST(l_orderkey % 40 + 5 AS INTEGER) AS return_delay,
  CAST(l_orderkey % CAST(l_quantity AS BIGINT) + 1 AS INTEGER) AS quantity_returned
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "c_gross": """
SELECT l.*, p.unit_retail_price, p.unit_cost_price, s.region_code, s.is_digital,
  CAST(quantity_sold * unit_retail_price AS DECIMAL(14,4)) AS gross_revenue,
  CASE WHEN s.region_code = 'EMEA' AND order_number % 3 = 0 THEN 'EUR' WHEN s.region_code = 'EMEA' AND order_number % 3 = 1 THEN 'GBP'
    WHEN s.region_code = 'APAC' AND order_number % 3 = 0 THEN 'CNY' WHEN s.region_code = 'APAC' AND order_number % 3 = 1 THEN 'JPY'
    ELSE 'USD' END AS currency_code,
  CASE WHEN is_digital THEN 'ECOM_PLATFORM' ELSE 'POS_SYSTEM' END AS source_system
FROM c_lines l LEFT JOIN c_prices p USING (product_sk) LEFT JOIN c_stores s USING (store_sk)""",
    "c_priced": """
SELECT *, CAST(quantity_sold * unit_retail_price * discount_rate AS DECIMAL(12,4)) AS discount_amount,
  CAST(CASE currency_code WHEN 'EUR' THEN 1.08 WHEN 'GBP' THEN 1.27 WHEN 'CNY' THEN 0.14 WHEN 'JPY' THEN 0.0067 ELSE 1 END
    AS DECIMAL(10,6)) AS exchange_rate
FROM c_gross""",
    "c_sales": "",
    "c_promoted": "",
    "c_returns": f"""
SELECT {key60("'RET'", "transaction_sk")} AS return_sk,
  'RET-' || upper(substr(md5(CAST(transaction_sk AS VARCHAR)), 1, 8)) AS return_id, 1 AS return_line_number,
  return_date, {date_sk("return_date")} AS return_date_sk, transaction_sk AS original_transaction_sk,
  transaction_date_sk AS original_transaction_date_sk, customer_sk, product_sk, store_sk, channel_sk,
  return_reason_code, return_reason_desc, return_condition, quantity_returned, return_retail_amount, return_cost_amount,
  CAST(return_retail_amount - restocking_fee AS DECIMAL(14,4)) AS refund_amount, restocking_fee,
  return_delay AS days_since_purchase, return_delay <= 30 AS is_within_return_window
FROM (SELECT *, CAST(CASE WHEN return_condition <> 'SALEABLE' OR return_reason_code = 'CHANGED_MIND'
    THEN return_retail_amount * CAST(0.15 AS DECIMAL(3,2)) ELSE 0 END AS DECIMAL(14,4)) AS restocking_fee
  FROM (SELECT *, CASE WHEN return_reason_code IN ('DEFECT', 'DAMAGED')
      THEN CASE WHEN order_number % 20 < 2 THEN 'SALEABLE' WHEN order_number % 20 < 10 THEN 'DAMAGED' ELSE 'DEFECTIVE' END
      ELSE CASE WHEN order_number % 20 < 17 THEN 'SALEABLE' WHEN order_number % 20 < 19 THEN 'DAMAGED' ELSE 'DEFECTIVE' END
      END AS return_condition
    FROM (SELECT l.*, transaction_date + return_delay AS return_date,
        {pick(REASONS, "product_sk")} AS return_reason_code, {pick(REASON_TEXTS, "product_sk")} AS return_reason_desc,
        CAST(quantity_returned * unit_retail_price AS DECIMAL(14,4)) AS return_retail_amount,
        CAST(quantity_returned * unit_cost_price AS DECIMAL(14,4)) AS return_cost_amount
      FROM c_lines l LEFT JOIN c_prices USING (product_sk) WHERE return_flag = 'Y')
    WHERE return_date <= (SELECT horizon FROM c_span)))""",
    "c_funnels": f"""
SELECT {key60("visitor_id", "session_date")} AS session_sk, visitor_id, session_date, {date_sk("session_date")} AS session_date_sk,
  CAST(micros // 1000000 AS INTEGER) AS session_duration_seconds, pages_viewed,
  CASE WHEN pages_viewed > 1 THEN views ELSE 0 END AS products_viewed,
  CASE WHEN pages_viewed > 1 THEN adds ELSE 0 END AS products_added_to_cart,
  CAST(CASE WHEN pages_viewed > 1 THEN cart ELSE 0 END AS DECIMAL(12,4)) AS cart_value,
  pages_viewed > 1 AND (adds > 0 OR buys > 0) AS checkout_initiated_flag, pages_viewed > 1 AND buys > 0 AS purchase_completed_flag,
  pages_viewed = 1 AS bounce_flag, entry_page, CASE WHEN pages_viewed = 1 THEN entry_page ELSE last_page END AS exit_page
FROM (SELECT user_id AS visitor_id, CAST(ts AS DATE) - 9131 AS session_date, count(*) AS pages_viewed,
    count(*) FILTER (WHERE event_type = 'view') AS views, count(*) FILTER (WHERE event_type = 'click') AS adds,
    count(*) FILTER (WHERE event_type = 'purchase') AS buys,
    coalesce(sum(CAST(value AS DECIMAL(12,2))) FILTER (WHERE event_type = 'click'), 0) AS cart,
    epoch_us(max(ts)) - epoch_us(min(ts)) AS micros,
    '/' || arg_min(event_type, (ts, event_id)) AS entry_page, '/' || arg_max(event_type, (ts, event_id)) AS last_page
  FROM events GROUP BY 1, 2)""",
    "c_attributed": """
SELECT f.* REPLACE (s.transaction_sk IS NOT NULL AS purchase_completed_flag), s.transaction_sk AS purchase_transaction_sk,
  CASE WHEN s.transaction_sk IS NOT NULL THEN CAST(f.cart_value AS DECIMAL(14,4)) END AS purchase_revenue
FROM (SELECT *, CASE WHEN purchase_completed_flag THEN
    row_number() OVER (PARTITION BY session_date, purchase_completed_flag ORDER BY session_sk) END AS n FROM c_funnels) f
LEFT JOIN (SELECT transaction_sk, transaction_date, row_number() OVER (PARTITION BY transaction_date ORDER BY transaction_sk) AS n
  FROM c_lines WHERE channel_sk IN (2, 3, 4)) s ON s.transaction_date = f.session_date AND s.n = f.n""",
    "c_sessions": f"""
SELECT * EXCLUDE (visitor_id, n), visitor_id || '-' || session_date_sk AS session_id,
  CASE WHEN visitor_id % 5 < 2 THEN visitor_id END AS customer_sk, {pick((2, 3, 4), "visitor_id")} AS channel_sk,
  {pick(("DESKTOP", "MOBILE", "TABLET", "APP"), "visitor_id")} AS device_type,
  CASE WHEN visitor_id % 4 = 0 THEN {pick(("Windows", "MacOS", "Linux"), "visitor_id")}
    ELSE {pick(("iOS", "Android"), "visitor_id")} END AS os_platform,
  CASE WHEN visitor_id % 4 <> 3 THEN {pick(("Chrome", "Safari", "Firefox", "Edge", "Samsung Internet"), "visitor_id")} END AS browser_name,
  {pick(("ORGANIC", "PAID", "EMAIL", "SOCIAL", "DIRECT", "REFERRAL", "AFFILIATE"), "visitor_id")} AS traffic_source,
  CASE WHEN visitor_id % 7 IN (1, 2, 3) THEN 'CMP-' || (visitor_id % 9000 + 1000) END AS campaign_id
FROM c_attributed""",
    "c_items": """
SELECT item_sk AS product_sk, min(q.p_brand) AS category_name, min(q.p_type) AS subcategory_name,
  min(unit_cost_price) AS unit_cost, min(unit_retail_price) AS unit_retail
FROM c_parts q JOIN c_prices r ON q.p_partkey = r.product_sk GROUP BY item_sk""",
    "c_sites": "SELECT CAST(n_nationkey AS BIGINT) AS store_sk, region_name FROM c_places",
    "c_moves": """
SELECT item_sk AS product_sk, CAST(s_nationkey AS BIGINT) AS store_sk, CAST(l_shipdate AS DATE) AS move_date,
  CAST(coalesce(sum(CAST(l_quantity AS BIGINT)) FILTER (WHERE l_linestatus = 'O'), 0) AS BIGINT) AS units_received,
  CAST(coalesce(sum(CAST(l_quantity AS BIGINT)) FILTER (WHERE l_linestatus = 'F'), 0) AS BIGINT) AS units_sold
FROM lineitem JOIN c_parts ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2, 3""",
    "c_monthends": """
SELECT product_sk, store_sk, last_day(CAST(m AS DATE)) AS move_date
FROM (SELECT product_sk, store_sk, unnest(generate_series(CAST(date_trunc('month', min(move_date)) AS TIMESTAMP),
    (SELECT CAST(last_day AS TIMESTAMP) FROM c_span), INTERVAL 1 MONTH)) AS m FROM c_moves GROUP BY 1, 2)""",
    "c_levels": """
SELECT product_sk, store_sk, move_date, today_in AS units_received_today, today_out AS units_sold_today,
  100 + total AS on_hand_qty
FROM (SELECT *, CAST(sum(today_in - today_out) OVER (PARTITION BY product_sk, store_sk ORDER BY move_date) AS BIGINT) AS total
  FROM (SELECT product_sk, store_sk, move_date, CAST(sum(i) AS BIGINT) AS today_in, CAST(sum(o) AS BIGINT) AS today_out, max(w) AS wanted
    FROM (SELECT product_sk, store_sk, move_date, units_received AS i, units_sold AS o, 0 AS w FROM c_moves
      UNION ALL SELECT product_sk, store_sk, move_date, 0, 0, 1 FROM c_monthends)
    GROUP BY 1, 2, 3))
WHERE wanted = 1""",
    "c_inventory": f"""
SELECT {key60("product_sk", "store_sk", date_sk("move_date"))} AS inventory_sk, move_date AS snapshot_date,
  {date_sk("move_date")} AS snapshot_date_sk, product_sk, store_sk, on_hand_qty, in_transit_qty, on_order_qty, reserved_qty,
  greatest(0, on_hand_qty - reserved_qty) AS available_to_sell_qty, units_received_today, units_sold_today,
  CAST(on_hand_qty * unit_cost AS DECIMAL(16,4)) AS inventory_cost_value,
  CAST(on_hand_qty * unit_retail AS DECIMAL(16,4)) AS inventory_retail_value, 20 AS reorder_point,
  CAST(round(CAST(on_hand_qty / 2.5::DOUBLE AS DECIMAL(38,8)), 2) AS DOUBLE) AS days_of_supply,
  CASE WHEN on_hand_qty > 0 THEN CAST(round(CAST(365 / CAST(round(CAST(on_hand_qty / 2.5::DOUBLE AS DECIMAL(38,8)), 2) AS DOUBLE) AS DECIMAL(38,8)), 4) AS DOUBLE) ELSE 0 END AS stock_turn_rate,
  CASE WHEN greatest(0, on_hand_qty - reserved_qty) = 0 THEN 'Y' ELSE 'N' END AS stockout_flag
FROM (SELECT *, CASE WHEN on_hand_qty < 50 THEN number % 30 ELSE 0 END AS in_transit_qty,
    CASE WHEN on_hand_qty < 30 THEN number % 50 ELSE 0 END AS on_order_qty,
    greatest(0, least(number % 10, on_hand_qty)) AS reserved_qty
  FROM (SELECT *, product_sk + store_sk + month(move_date) AS number FROM c_levels JOIN c_items USING (product_sk)))""",
}


def _amounts(discounted: str) -> str:
    return f"""
SELECT *, CASE WHEN net_revenue_usd > 30000 THEN 'High-Value' WHEN net_revenue_usd > 10000 THEN 'Mid-Value' ELSE 'Low-Value' END AS revenue_tier,
  CASE WHEN net_revenue > 0 THEN CAST(round(CAST(CAST(gross_margin AS DOUBLE) / CAST(net_revenue AS DOUBLE) * 100 AS DECIMAL(38,8)), 4) AS DOUBLE) ELSE 0 END AS gross_margin_pct
FROM (SELECT *, CAST(net_revenue - cost_of_goods_sold AS DECIMAL(14,4)) AS gross_margin,
    CAST(net_revenue + tax_amount AS DECIMAL(14,4)) AS total_transaction_amount,
    CAST(net_revenue * exchange_rate AS DECIMAL(14,4)) AS net_revenue_usd
  FROM (SELECT *, CAST(net_revenue * tax_rate AS DECIMAL(12,4)) AS tax_amount,
      CAST(quantity_sold * unit_cost_price AS DECIMAL(14,4)) AS cost_of_goods_sold
    FROM (SELECT *, CAST(gross_revenue - discount_amount AS DECIMAL(14,4)) AS net_revenue FROM {discounted})))"""


CTES["c_sales"] = _amounts("c_priced")
CTES["c_promoted"] = _amounts("""(
      SELECT g.* REPLACE (r.promotion_sk AS promotion_sk), CAST(CASE r.discount_type
          WHEN 'PERCENT' THEN gross_revenue * r.discount_value * CAST(0.01 AS DECIMAL(3,2))
          WHEN 'FIXED_AMOUNT' THEN least(r.discount_value, gross_revenue) ELSE 0 END AS DECIMAL(12,4)) AS discount_amount,
        CAST(CASE currency_code WHEN 'EUR' THEN 1.08 WHEN 'GBP' THEN 1.27 WHEN 'CNY' THEN 0.14 WHEN 'JPY' THEN 0.0067 ELSE 1 END
          AS DECIMAL(10,6)) AS exchange_rate
      FROM c_gross g LEFT JOIN c_promotions r
        ON g.promotion_sk = r.promotion_sk AND g.transaction_date BETWEEN r.start_date AND r.end_date)""")


def sql(body: str) -> str:
    """Put the common table expressions that a query names in front of it."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in dict.fromkeys(re.findall(r"\bc_[a-z]+\b", text)):
            if name in CTES and name not in needed:
                visit(CTES[name])
                needed.append(name)

    visit(body)
    if not needed:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in needed) + "\n" + body


def money(column: str) -> str:
    return f"CAST(sum({column}) AS DECIMAL(24,4))"


def units(column: str) -> str:
    return f"CAST(sum({column}) AS BIGINT)"


def ratio(a: str, b: str) -> str:
    return f"CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0)"


def half_up(value: str, places: int) -> str:
    return f"CAST(round(CAST({value} AS DECIMAL(38,8)), {places}) AS DOUBLE)"


def declared_sql(table: str, source: str, missing: dict[str, str], more: str = "") -> str:
    """All declared columns of a table, in their types; `missing` has the values of those that the source lacks."""
    names = {"STRING": "VARCHAR", "INT": "INTEGER"}
    columns = [f"CAST({missing.get(c, c)} AS {names.get(t, t)}) AS {c}" for c, t in TABLES[table].types.items()]
    return f"SELECT {', '.join(columns)}{more} FROM {source}"


LOAD = {c: "TIMESTAMP '2024-01-01 00:00:00'" for c in ("load_timestamp", "created_timestamp", "updated_timestamp")}
# Columns that no rule fills: the declared default, or NULL.
UNFILLED = {
    "fact_sales_transactions": LOAD,
    "fact_inventory_snapshot": LOAD | {"units_returned_today": "0", "units_shrinkage_today": "0"},
    "fact_returns": LOAD | {"return_shipping_cost": "0"},
    "fact_web_sessions": LOAD,
    "dim_customer": LOAD,
    "dim_product": LOAD | {"collab_partner": "NULL"},
    "dim_store": LOAD | {"store_manager_employee_sk": "NULL"},
    "dim_geography": {"population": "NULL", "gdp_per_capita_usd": "NULL"},
}


def whole_sql(table: str, source: str, more: str = "") -> str:
    return declared_sql(table, source, UNFILLED[table], more)
