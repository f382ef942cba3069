"""The two declared layers: the metric view and the semantic layer.

They share measures and formulas. Trailing windows of the metric view end the
day before; those of the semantic layer include the day itself, and its windows
run over a gap-free day spine.
"""

from __future__ import annotations

from dataclasses import replace

from shelfline.functions.ratios import growth_percent, percent, ratio
from shelfline.metrics.model import (
    Condition,
    Derived,
    Dimension,
    Entity,
    Format,
    Input,
    Measure,
    Metric,
    Simple,
    TimeDimension,
    Windowed,
    layer_of,
)

NET = Measure("money", "net_revenue_usd")
CUSTOMERS = Measure("distinct", "customer_sk")
TRANSACTIONS = Measure("distinct", "transaction_id")

USD = Format("currency", "USD", 2)
COMPACT_USD = Format("currency", "USD", 2, compact=True)
PERCENT = Format("percentage", places=2)
SHARE = Format("percentage", places=2, fraction=True)
COUNT = Format("number")

# Metric and dimension names, labels and synonyms are the layers' public names.
SIMPLE = (
    Simple("total_net_revenue", "Total Net Revenue", "Net revenue in dollars.",
           ("revenue", "net sales", "total sales"), COMPACT_USD, NET),
    Simple("total_gross_revenue", "Total Gross Revenue", "Revenue before discounts.",
           ("gross sales",), USD, Measure("money", "gross_revenue")),
    Simple("total_cogs", "Total COGS", "Cost of the goods sold.",
           ("cost", "cogs"), USD, Measure("money", "cost_of_goods_sold")),
    Simple("total_discount", "Total Discount", "Discounts given.",
           (), USD, Measure("money", "discount_amount")),
    Simple("total_quantity", "Total Units Sold", "Units sold.",
           ("units", "quantity"), COUNT, Measure("units", "quantity_sold")),
    Simple("transaction_count", "Transaction Count", "Different transactions.",
           ("number of transactions", "order count"), COUNT, TRANSACTIONS),
    Simple("unique_customers", "Unique Customers", "Different known customers.",
           ("customer count",), COUNT, CUSTOMERS),
    Simple("return_transactions", "Return Transactions", "Different transactions with a returned line.",
           (), None, TRANSACTIONS, where=Condition("return_flag", "=", "Y")),
)


def _inputs(*names: str) -> tuple[Input, ...]:
    return tuple(Input(n) for n in names)


COMPOSED = (
    Derived("gross_margin", "Gross Margin", "Net revenue less cost of goods.", ("profit", "margin"), USD,
            _inputs("total_net_revenue", "total_cogs"),
            lambda net, cogs: (net - cogs).cast("decimal(24,4)")),
    Derived("gross_margin_pct", "Gross Margin %", "Gross margin in percent of net revenue.",
            ("margin percent", "profitability"), PERCENT,
            _inputs("total_net_revenue", "total_cogs"), lambda net, cogs: percent(net - cogs, net)),
    Derived("avg_order_value", "Avg Order Value", "Net revenue per transaction.",
            ("aov", "average basket"), USD,
            _inputs("total_net_revenue", "transaction_count"), ratio),
    Derived("avg_selling_price", "Avg Selling Price", "Net revenue per unit.", ("asp",), USD,
            _inputs("total_net_revenue", "total_quantity"), ratio),
    Derived("discount_rate", "Discount Rate", "Discount as a share of gross revenue.", (), SHARE,
            _inputs("total_discount", "total_gross_revenue"), ratio),
    Derived("return_rate", "Return Rate", "Share of transactions with a return.", ("refund rate",), SHARE,
            _inputs("return_transactions", "transaction_count"), ratio),
)

TRAILING = (
    Windowed("trailing_7d_revenue", "Trailing 7-Day Revenue", "Net revenue of the last seven days.", (), USD,
             NET, "trailing", days=7),
    Windowed("trailing_7d_customers", "Trailing 7-Day Customers", "Different customers of the last seven days.",
             (), None, CUSTOMERS, "trailing", days=7),
)

RUNNING = (
    Windowed("cumulative_revenue", "Cumulative Revenue", "Net revenue up to the day.", (), USD, NET, "cumulative"),
    Windowed("ytd_revenue", "YTD Revenue", "Net revenue since the start of the year.",
             ("year to date revenue",), USD, NET, "to_date", grain="year"),
)

METRIC_VIEW = layer_of(
    "metric_view",
    "transaction_date",
    dimensions=(
        TimeDimension("transaction_date", "Transaction Date", "Day of the sale.",
                      ("sale date", "order date"), Format("date"), grain="day"),
        TimeDimension("transaction_month", "Transaction Month", "First day of the sale's month.", grain="month"),
        TimeDimension("transaction_year", "Transaction Year", "First day of the sale's year.", grain="year"),
        Dimension("store_name", "Store Name", "", ("store", "location name"), column="store_name", entity="store"),
        Dimension("region_name", "Region", "", ("region", "geography"), column="region_name", entity="store"),
        Dimension("country_name", "Country", column="country_name", entity="store"),
        Dimension("store_format", "Store Format", "", ("format",), column="store_format", entity="store"),
        Dimension("division_name", "Division", "", ("business unit",), column="division_name", entity="product"),
        Dimension("category_name", "Product Category", "", ("category",), column="category_name", entity="product"),
        Dimension("product_name", "Product Name", "", ("item", "product"), column="product_name", entity="product"),
        Dimension("gender_target", "Gender Target", column="gender_target", entity="product"),
        Dimension("revenue_tier", "Revenue Tier", "Tier of the line by net revenue.",
                  ("value segment", "transaction tier"), column="revenue_tier"),
    ),
    metrics=(
        *SIMPLE,
        *COMPOSED,
        *TRAILING,
        Windowed("current_day_revenue", "Current Day Revenue", "Net revenue of the day.", (), None, NET, "current"),
        Windowed("previous_day_revenue", "Previous Day Revenue", "Net revenue of the day before.", (), None,
                 NET, "trailing", days=1),
        Derived("day_over_day_growth", "Day-over-Day Growth %", "Change against the day before, in percent.",
                ("dod growth",), PERCENT,
                _inputs("current_day_revenue", "previous_day_revenue"), growth_percent),
        *RUNNING,
    ),
    entities=(Entity("store", "store_sk", "store_sk"), Entity("product", "product_sk", "product_sk")),
)

# Attributes that the semantic layer exposes, by entity, with their labels.
ENTITY_ATTRIBUTES = {
    "store": {
        "store_name": "Store Name", "region_name": "Region", "country_name": "Country",
        "store_format": "Store Format", "state_province_name": "State / Province", "city": "City",
        "is_active": "Is Active",
    },
    "product": {
        "division_name": "Division", "category_name": "Product Category", "subcategory_name": "Subcategory",
        "product_name": "Product Name", "gender_target": "Gender Target", "age_group": "Age Group",
        "sport_occasion": "Sport / Occasion", "is_hero_product": "Hero Product Flag",
    },
    "customer": {
        "loyalty_tier": "Loyalty Tier", "customer_segment": "Customer Segment", "gender_code": "Customer Gender",
        "country_code": "Customer Country", "lifetime_value_band": "Lifetime Value Band",
        "acquisition_channel": "Acquisition Channel",
    },
}
FACT_ATTRIBUTES = {"revenue_tier": "Revenue Tier", "return_flag": "Return Flag", "currency_code": "Currency Code"}
TIME_GRAINS = ("day", "week", "month", "quarter", "year")


def _plain(*metrics: Metric, **changes: object) -> list[Metric]:
    """Metrics as the semantic layer has them, which declares neither formats nor synonyms."""
    return [replace(m, format=None, synonyms=(), **changes) for m in metrics]


SEMANTIC_LAYER = layer_of(
    "semantic_layer",
    "transaction_date",
    dimensions=(
        *[TimeDimension(f"metric_time__{g}", f"Transaction Date by {g}", grain=g) for g in TIME_GRAINS],
        *[
            Dimension(f"{entity}__{column}", label, column=column, entity=entity)
            for entity, attributes in ENTITY_ATTRIBUTES.items()
            for column, label in attributes.items()
        ],
        *[Dimension(f"transaction__{c}", label, column=c) for c, label in FACT_ATTRIBUTES.items()],
    ),
    metrics=(
        *_plain(*SIMPLE, *COMPOSED),
        *_plain(*TRAILING, include_today=True),
        *_plain(*RUNNING),
        Derived("day_over_day_revenue_growth", "Day-over-Day Growth %",
                "Change against the day before, in percent.", (), None,
                (Input("total_net_revenue"), Input("total_net_revenue", days_ago=1)), growth_percent),
    ),
    entities=(
        Entity("store", "store_sk", "store_sk"),
        Entity("product", "product_sk", "product_sk"),
        Entity("customer", "customer_sk", "customer_sk"),
    ),
    spine=True,
)
