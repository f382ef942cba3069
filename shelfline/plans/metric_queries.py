"""The published queries on the metric view and on the semantic layer."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame

from shelfline.metrics.layers import METRIC_VIEW, SEMANTIC_LAYER
from shelfline.metrics.model import Condition, Layer, Sources
from shelfline.metrics.query import metric_query


@dataclass(frozen=True)
class SavedQuery:
    layer: Layer
    metrics: dict[str, str]
    group_by: dict[str, str]
    where: tuple[Condition, ...] = ()
    order_by: tuple[str, ...] = ()

    def run(self, sources: Sources) -> DataFrame:
        return metric_query(self.layer, sources, self.metrics, self.group_by, self.where, self.order_by)


def _same(*names: str) -> dict[str, str]:
    return {n: n for n in names}


def metric_view_queries(since: date, since_later: date) -> dict[str, SavedQuery]:
    """Nine queries; the first date bounds the long reports, the second the daily ones."""
    early = (Condition("transaction_date", ">=", since),)
    late = (Condition("transaction_date", ">=", since_later),)

    def saved(metrics: dict[str, str], group_by: dict[str, str], where: tuple[Condition, ...]) -> SavedQuery:
        return SavedQuery(METRIC_VIEW, metrics, group_by, where)

    return {
        "q_mv_atomic": saved(
            {
                "net_revenue": "total_net_revenue", "gross_revenue": "total_gross_revenue",
                "units_sold": "total_quantity", "txn_count": "transaction_count", "customers": "unique_customers",
            },
            _same("region_name", "category_name"), early,
        ),
        "q_mv_composed": saved(
            {
                "net_revenue": "total_net_revenue", "cogs": "total_cogs", "gross_margin": "gross_margin",
                "margin_pct": "gross_margin_pct", "aov": "avg_order_value", "asp": "avg_selling_price",
                "discount_rate": "discount_rate", "return_rate": "return_rate",
            },
            _same("division_name", "category_name"), early,
        ),
        "q_mv_trailing_by_store": saved(
            {"t7d_revenue": "trailing_7d_revenue", "t7d_customers": "trailing_7d_customers"},
            _same("transaction_date", "store_name"), late,
        ),
        "q_mv_day_over_day": saved(
            {
                "today_revenue": "current_day_revenue", "yesterday_revenue": "previous_day_revenue",
                "dod_growth_pct": "day_over_day_growth",
            },
            _same("transaction_date", "region_name"), late,
        ),
        "q_mv_cumulative": saved(
            {"daily_revenue": "total_net_revenue", "running_total": "cumulative_revenue"},
            _same("transaction_date"), early,
        ),
        "q_mv_ytd": saved(
            {"ytd_revenue": "ytd_revenue"},
            {"transaction_date": "transaction_date", "month": "transaction_month"}, early,
        ),
        "q_mv_join_slice": saved(
            {"net_revenue": "total_net_revenue", "margin_pct": "gross_margin_pct", "aov": "avg_order_value"},
            _same("region_name", "country_name", "store_format", "division_name", "gender_target"), early,
        ),
        "q_mv_revenue_tier": saved(
            {
                "txn_count": "transaction_count", "net_revenue": "total_net_revenue",
                "asp": "avg_selling_price", "return_rate": "return_rate",
            },
            _same("revenue_tier"), early,
        ),
        "q_mv_kpi_board": saved(
            {
                "daily_revenue": "total_net_revenue", "t7d_revenue": "trailing_7d_revenue",
                "running_total": "cumulative_revenue", "ytd_revenue": "ytd_revenue",
                "dod_growth_pct": "day_over_day_growth", "margin_pct": "gross_margin_pct",
                "aov": "avg_order_value", "discount_rate": "discount_rate",
                "t7d_customers": "trailing_7d_customers",
            },
            _same("transaction_date", "region_name", "category_name"), late,
        ),
    }


def semantic_layer_queries(country: str) -> dict[str, SavedQuery]:
    """Thirteen queries; ``country`` is the value of the entity filter."""

    def saved(metrics: str, *keys: str, order: bool = True, where: tuple[Condition, ...] = ()) -> SavedQuery:
        return SavedQuery(SEMANTIC_LAYER, _same(*metrics.split(",")), _same(*keys), where, keys if order else ())

    month, day = "metric_time__month", "metric_time__day"
    return {
        "q_sl_revenue_by_month": saved("total_net_revenue", month),
        "q_sl_revenue_by_region": saved("total_net_revenue", "store__region_name"),
        "q_sl_counts_by_category": saved("transaction_count,unique_customers", "product__category_name"),
        "q_sl_returns_by_month": saved("return_transactions", month, order=False),
        "q_sl_margin_by_region": saved("gross_margin,gross_margin_pct", "store__region_name", order=False),
        "q_sl_aov_by_format": saved("avg_order_value", "store__store_format", order=False),
        "q_sl_discount_by_division": saved("discount_rate", "product__division_name", order=False),
        "q_sl_return_rate_by_month": saved("return_rate", month),
        "q_sl_trailing_by_day": saved("trailing_7d_revenue", day),
        "q_sl_ytd_by_month": saved("ytd_revenue", month),
        "q_sl_cumulative_by_day": saved("cumulative_revenue", day),
        "q_sl_dod_by_day": saved("day_over_day_revenue_growth", day),
        "q_sl_country_quarter": saved(
            "total_net_revenue,gross_margin_pct", "store__country_name", "metric_time__quarter", order=False,
            where=(Condition("store__country_name", "=", country),),
        ),
    }
