"""What the two layers have to declare, written out by hand, apart from the library's own tables.

Fixed values: names, labels, formats and synonyms of the published layers. A format is its type, with the currency, the places
(all or a number) and `compact` where it has them.
"""

from __future__ import annotations

METRIC_VIEW_METRICS = """
total_net_revenue | simple | Total Net Revenue | currency USD 2 compact | revenue, net sales, total sales
total_gross_revenue | simple | Total Gross Revenue | currency USD 2 | gross sales
total_cogs | simple | Total COGS | currency USD 2 | cost, cogs
total_discount | simple | Total Discount | currency USD 2 |
total_quantity | simple | Total Units Sold | number all | units, quantity
transaction_count | simple | Transaction Count | number all | number of transactions, order count
unique_customers | simple | Unique Customers | number all | customer count
return_transactions | simple | Return Transactions | |
gross_margin | derived | Gross Margin | currency USD 2 | profit, margin
gross_margin_pct | derived | Gross Margin % | percentage 2 | margin percent, profitability
avg_order_value | derived | Avg Order Value | currency USD 2 | aov, average basket
avg_selling_price | derived | Avg Selling Price | currency USD 2 | asp
discount_rate | derived | Discount Rate | percentage 2 |
return_rate | derived | Return Rate | percentage 2 | refund rate
trailing_7d_revenue | cumulative | Trailing 7-Day Revenue | currency USD 2 |
trailing_7d_customers | cumulative | Trailing 7-Day Customers | |
current_day_revenue | cumulative | Current Day Revenue | |
previous_day_revenue | cumulative | Previous Day Revenue | |
day_over_day_growth | derived | Day-over-Day Growth % | percentage 2 | dod growth
cumulative_revenue | cumulative | Cumulative Revenue | currency USD 2 |
ytd_revenue | cumulative | YTD Revenue | currency USD 2 | year to date revenue
"""

METRIC_VIEW_DIMENSIONS = """
transaction_date | dimension | Transaction Date | date | sale date, order date
transaction_month | dimension | Transaction Month | |
transaction_year | dimension | Transaction Year | |
store_name | dimension | Store Name | | store, location name
region_name | dimension | Region | | region, geography
country_name | dimension | Country | |
store_format | dimension | Store Format | | format
division_name | dimension | Division | | business unit
category_name | dimension | Product Category | | category
product_name | dimension | Product Name | | item, product
gender_target | dimension | Gender Target | |
revenue_tier | dimension | Revenue Tier | | value segment, transaction tier
"""

SEMANTIC_METRICS = """
total_net_revenue | simple | Total Net Revenue | |
total_gross_revenue | simple | Total Gross Revenue | |
total_cogs | simple | Total COGS | |
total_discount | simple | Total Discount | |
total_quantity | simple | Total Units Sold | |
transaction_count | simple | Transaction Count | |
unique_customers | simple | Unique Customers | |
return_transactions | simple | Return Transactions | |
gross_margin | derived | Gross Margin | |
gross_margin_pct | derived | Gross Margin % | |
avg_order_value | derived | Avg Order Value | |
avg_selling_price | derived | Avg Selling Price | |
discount_rate | derived | Discount Rate | |
return_rate | derived | Return Rate | |
trailing_7d_revenue | cumulative | Trailing 7-Day Revenue | |
trailing_7d_customers | cumulative | Trailing 7-Day Customers | |
cumulative_revenue | cumulative | Cumulative Revenue | |
ytd_revenue | cumulative | YTD Revenue | |
day_over_day_revenue_growth | derived | Day-over-Day Growth % | |
"""

SEMANTIC_DIMENSIONS = """
metric_time__day | dimension | Transaction Date by day | |
metric_time__week | dimension | Transaction Date by week | |
metric_time__month | dimension | Transaction Date by month | |
metric_time__quarter | dimension | Transaction Date by quarter | |
metric_time__year | dimension | Transaction Date by year | |
store__store_name | dimension | Store Name | |
store__region_name | dimension | Region | |
store__country_name | dimension | Country | |
store__store_format | dimension | Store Format | |
store__state_province_name | dimension | State / Province | |
store__city | dimension | City | |
store__is_active | dimension | Is Active | |
product__division_name | dimension | Division | |
product__category_name | dimension | Product Category | |
product__subcategory_name | dimension | Subcategory | |
product__product_name | dimension | Product Name | |
product__gender_target | dimension | Gender Target | |
product__age_group | dimension | Age Group | |
product__sport_occasion | dimension | Sport / Occasion | |
product__is_hero_product | dimension | Hero Product Flag | |
customer__loyalty_tier | dimension | Loyalty Tier | |
customer__customer_segment | dimension | Customer Segment | |
customer__gender_code | dimension | Customer Gender | |
customer__country_code | dimension | Customer Country | |
customer__lifetime_value_band | dimension | Lifetime Value Band | |
customer__acquisition_channel | dimension | Acquisition Channel | |
transaction__revenue_tier | dimension | Revenue Tier | |
transaction__return_flag | dimension | Return Flag | |
transaction__currency_code | dimension | Currency Code | |
"""

DECLARED = {"metric_view": METRIC_VIEW_METRICS + METRIC_VIEW_DIMENSIONS, "semantic_layer": SEMANTIC_METRICS + SEMANTIC_DIMENSIONS}

# Ratios that a percentage shows times a hundred; the other percentages are percent already.
SHARES = ("discount_rate", "return_rate")


def entries() -> list[tuple[str, str, str, str, str, str]]:
    """(layer, name, kind, label, format, synonyms) of all entries."""
    rows = []
    for layer, text in DECLARED.items():
        for line in text.strip().splitlines():
            if line.strip():
                rows.append((layer, *(cell.strip() for cell in line.split("|"))))
    return rows


def cell(value: str) -> str:
    return "NULL" if value == "" else "'" + value.replace("'", "''") + "'"


def entry_rows() -> str:
    """The entries as rows of a VALUES list; no synonyms are an empty text."""
    return ", ".join(f"({', '.join(map(cell, row[:5]))}, '{row[5]}')" for row in entries())


def shown_sql(value: str = "value") -> str:
    """The text of each metric that declares a format, by layer and name."""

    def fixed(number: str, places: int) -> str:
        return f"format('{{:,.{places}f}}', CAST(CAST(CAST({number} AS VARCHAR) AS DECIMAL(38,{places})) AS DOUBLE))"

    cases = []
    for layer, name, kind, _, how, _ in entries():
        if kind == "dimension" or not how:
            continue
        words = how.split()
        places = 0 if "all" in words else 2  # numbers with all places are counts here
        text = fixed(f"{value} * 100" if name in SHARES else value, places)
        if "compact" in words:
            steps = " ".join(f"WHEN abs({value}) >= {step} THEN {fixed(f'{value} / {step}', places)} || '{letter}'" for step, letter in (("1e9", "B"), ("1e6", "M"), ("1e3", "K")))
            text = f"CASE {steps} ELSE {text} END"
        text = {"currency": f"'$' || {text}", "percentage": f"{text} || '%'"}.get(words[0], text)
        cases.append(f"WHEN layer = '{layer}' AND name = '{name}' THEN {text}")
    return f"CASE {' '.join(cases)} END"


def formatted() -> str:
    """(layer, name) of each metric that declares a format."""
    return ", ".join(f"('{layer}', '{name}')" for layer, name, kind, _, how, _ in entries() if how and kind != "dimension")
