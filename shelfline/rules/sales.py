"""The sales fact."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline import params
from shelfline.operators.filters import revenue_tier, source_system
from shelfline.operators.joins import many_to_one, valid_promotion
from shelfline.rules.pricing import (
    exchange_rate,
    line_amounts,
    line_currency,
    promotion_discount,
    rate_discount,
    to_usd,
)

LINE_COLUMNS = (
    "transaction_sk", "transaction_id", "line_number", "transaction_date", "transaction_date_sk",
    "transaction_year", "customer_sk", "product_sk", "store_sk", "channel_sk", "promotion_sk",
    "employee_sk", "quantity_sold", "discount_rate", "tax_rate", "return_flag", "order_number",
)
# Not a column of the fact: joins between facts use it, since surrogate keys are hashes and may collide.
NATURAL_KEYS = ("transaction_nk",)
PRICE_COLUMNS = (
    "unit_retail_price", "unit_cost_price", "gross_revenue", "discount_amount", "net_revenue", "tax_amount",
    "total_transaction_amount", "cost_of_goods_sold", "gross_margin", "gross_margin_pct",
)
STORE_COLUMNS = ("currency_code", "exchange_rate", "source_system")
USD_COLUMNS = ("net_revenue_usd", "revenue_tier")
# Product columns that price a line, with their names on the line.
PRICES = {"standard_retail_price": "unit_retail_price", "standard_cost": "unit_cost_price"}


def needed_line_columns(columns: Iterable[str], entities: Iterable[str] = ()) -> list[str]:
    """Line columns that the wanted sales columns and entity keys are made from."""
    wanted = set(columns)
    needed = wanted & {*LINE_COLUMNS, *NATURAL_KEYS} | {"transaction_date_sk"} | {f"{e}_sk" for e in entities}
    if wanted & {*PRICE_COLUMNS, *USD_COLUMNS}:
        needed |= {"product_sk", "quantity_sold", "discount_rate", "tax_rate"}
    if wanted & {*STORE_COLUMNS, *USD_COLUMNS}:
        needed |= {"store_sk", "order_number"}
    return [c for c in (*LINE_COLUMNS, *NATURAL_KEYS) if c in needed]


def sales_columns(
    lines: DataFrame,
    products: Callable[[list[str]], DataFrame],
    stores: Callable[[list[str]], DataFrame],
    columns: Sequence[str],
    tiers: Sequence[tuple[object, str]] = params.REVENUE_TIERS,
    product_attributes: Sequence[str] = (),
    store_attributes: Sequence[str] = (),
) -> DataFrame:
    """The wanted columns of the sales fact, with attributes of product and store
    as _product_column and _store_column. Each of the two tables is joined at
    most once, and only when something is wanted from it. Lines without a date
    are dropped."""
    wanted = set(columns)
    usd = wanted & set(USD_COLUMNS)
    priced, placed = usd or wanted & set(PRICE_COLUMNS), usd or wanted & set(STORE_COLUMNS)
    out = lines.where(F.col("transaction_date_sk").isNotNull())
    if priced or product_attributes:
        prices = PRICES if priced else {}
        out = many_to_one(out, _renamed(products, "product", prices, product_attributes), "product_sk")
    if priced:
        quantity, retail = F.col("quantity_sold"), F.col("unit_retail_price")
        discount = rate_discount(quantity, retail, F.col("discount_rate"))
        amounts = line_amounts(quantity, retail, F.col("unit_cost_price"), discount, F.col("tax_rate"))
        out = out.withColumns({n: c for n, c in amounts.items() if n in wanted or (usd and n == "net_revenue")})
    if placed or store_attributes:
        own = {"region_code": "region_code", "is_digital": "is_digital"} if placed else {}
        out = many_to_one(out, _renamed(stores, "store", own, store_attributes), "store_sk")
    if placed:
        out = _with_currency(out)
    if usd:
        out = out.withColumn("net_revenue_usd", to_usd(F.col("net_revenue"), F.col("exchange_rate")))
    if "revenue_tier" in wanted:
        out = out.withColumn("revenue_tier", revenue_tier(F.col("net_revenue_usd"), tiers))
    carried = [f"_product_{c}" for c in product_attributes] + [f"_store_{c}" for c in store_attributes]
    return out.select(*columns, *carried)


def _renamed(
    read: Callable[[list[str]], DataFrame], name: str, own: Mapping[str, str], attributes: Sequence[str]
) -> DataFrame:
    """One read of a dimension: columns the fact itself uses, and carried attributes."""
    key = f"{name}_sk"
    frame = read([key, *dict.fromkeys([*own, *attributes])])
    return frame.select(
        key, *[F.col(c).alias(n) for c, n in own.items()], *[F.col(c).alias(f"_{name}_{c}") for c in attributes]
    )


def _with_currency(placed: DataFrame) -> DataFrame:
    currency = line_currency(F.col("region_code"), F.col("order_number"))
    return placed.withColumns(
        {
            "currency_code": currency,
            "exchange_rate": exchange_rate(currency),
            "source_system": source_system(F.col("is_digital")),
        }
    )


def build_fact_sales(lines: DataFrame, prices: DataFrame, stores: DataFrame, promotions: DataFrame) -> DataFrame:
    """Sales lines priced with the promotion that was valid on the day, if any."""
    dated = lines.where(F.col("transaction_date_sk").isNotNull())
    priced = many_to_one(dated, prices, "product_sk")
    placed = many_to_one(priced, stores.select("store_sk", "region_code", "is_digital"), "store_sk")
    promoted = valid_promotion(placed, promotions, keep=("discount_type", "discount_value"))
    quantity, retail = F.col("quantity_sold"), F.col("unit_retail_price")
    discount = promotion_discount(quantity * retail, F.col("discount_type"), F.col("discount_value"))
    amounts = line_amounts(quantity, retail, F.col("unit_cost_price"), discount, F.col("tax_rate"))
    return (
        _with_currency(promoted.withColumns(amounts))
        .withColumn("net_revenue_usd", to_usd(F.col("net_revenue"), F.col("exchange_rate")))
        .select(
            "transaction_sk", "transaction_id", "line_number", "transaction_date", "transaction_date_sk",
            "customer_sk", "product_sk", "store_sk", "channel_sk", "promotion_sk", "employee_sk",
            "quantity_sold", *PRICE_COLUMNS, "return_flag", *STORE_COLUMNS, "net_revenue_usd",
        )
    )
