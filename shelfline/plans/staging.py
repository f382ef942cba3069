"""Staging projections: the declared columns of a table plus derived ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline import params
from shelfline.functions.dates import date_from_sk, period_start
from shelfline.operators.filters import revenue_tier
from shelfline.schemas import TABLES


def declared(df: DataFrame, table: str) -> DataFrame:
    """The table's declared columns that the frame has, in declared order."""
    return df.select(*[c for c in TABLES[table].column_names if c in df.columns])


def stg_fact_sales(sales: DataFrame, tiers: Sequence[tuple[object, str]] = params.REVENUE_TIERS) -> DataFrame:
    """Sales with date, year and tier; rows without a date key are dropped."""
    day = date_from_sk(F.col("transaction_date_sk"))
    return (
        declared(sales, "fact_sales_transactions")
        .where(F.col("transaction_date_sk").isNotNull())
        .withColumns(
            {
                "transaction_date": day,
                "transaction_year": period_start(day, "year"),
                "revenue_tier": revenue_tier(F.col("net_revenue_usd"), tiers),
            }
        )
    )


def stg_dim_store(stores: DataFrame) -> DataFrame:
    return declared(stores, "dim_store")


def stg_dim_product(products: DataFrame) -> DataFrame:
    return declared(products, "dim_product")


def stg_dim_customer(customers: DataFrame) -> DataFrame:
    return customers.select("*")
