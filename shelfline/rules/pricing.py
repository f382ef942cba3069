"""Amounts of a sales line, in decimals, each kept to four places."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfline import params
from shelfline.functions.ratios import rounded_percent
from shelfline.functions.text import code_lookup

LINE_AMOUNT = "decimal(14,4)"
UNIT_AMOUNT = "decimal(12,4)"


def line_amounts(quantity: Column, retail: Column, cost: Column, discount: Column, tax_rate: Column) -> dict[str, Column]:
    """All amounts of a line. ``discount`` is an amount."""
    gross = (quantity * retail).cast(LINE_AMOUNT)
    discount = discount.cast(UNIT_AMOUNT)
    net = (gross - discount).cast(LINE_AMOUNT)
    tax = (net * tax_rate).cast(UNIT_AMOUNT)
    cogs = (quantity * cost).cast(LINE_AMOUNT)
    margin = (net - cogs).cast(LINE_AMOUNT)
    return {
        "gross_revenue": gross,
        "discount_amount": discount,
        "net_revenue": net,
        "tax_amount": tax,
        "total_transaction_amount": (net + tax).cast(LINE_AMOUNT),
        "cost_of_goods_sold": cogs,
        "gross_margin": margin,
        "gross_margin_pct": margin_percent(margin, net),
    }


def margin_percent(margin: Column, net: Column) -> Column:
    """Margin in percent of net revenue; 0 when there is no positive revenue."""
    return F.when(net > 0, rounded_percent(margin, net, 4)).otherwise(F.lit(0.0))


def rate_discount(quantity: Column, retail: Column, rate: Column) -> Column:
    return (quantity * retail * rate).cast(UNIT_AMOUNT)


def promotion_discount(gross: Column, discount_type: Column, value: Column) -> Column:
    """Discount of a promotion on a line; 0 without one and for free gifts."""
    return (
        F.when(discount_type == "PERCENT", (gross * value * F.lit("0.01").cast("decimal(3,2)")).cast(UNIT_AMOUNT))
        .when(discount_type == "FIXED_AMOUNT", F.least(value.cast(UNIT_AMOUNT), gross.cast(UNIT_AMOUNT)))
        .otherwise(F.lit(0).cast(UNIT_AMOUNT))
    )


def exchange_rate(currency: Column, rates: Mapping[str, object] = params.USD_RATES) -> Column:
    return code_lookup(currency, {k: F.lit(v).cast("decimal(10,6)") for k, v in rates.items()})


def to_usd(amount: Column, rate: Column) -> Column:
    return (amount * rate).cast(LINE_AMOUNT)


def line_currency(region: Column, number: Column) -> Column:
    """Currency a line is paid in: two local ones or dollars outside the Americas."""
    choice = F.pmod(number, F.lit(3))
    return (
        F.when((region == "EMEA") & (choice == 0), "EUR")
        .when((region == "EMEA") & (choice == 1), "GBP")
        .when((region == "APAC") & (choice == 0), "CNY")
        .when((region == "APAC") & (choice == 1), "JPY")
        .otherwise("USD")
    )
