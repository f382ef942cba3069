from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from shelfline import params
from shelfline.functions import ratios, text
from shelfline.operators import filters
from shelfline.rules import customers, inventory, pricing, promotions, returns, sessions, stores


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def dec(value, kind="decimal(14,4)"):
    return F.lit(value).cast(kind)


def test_tiers_exclude_their_threshold(spark):
    df = spark.createDataFrame([("500",), ("500.0001",), ("100",), ("100.0001",), (None,)], "a STRING")
    tier = filters.revenue_tier(F.col("a").cast("decimal(14,4)"))
    assert [r.t for r in df.select(tier.alias("t")).collect()] == [
        "Mid-Value", "High-Value", "Low-Value", "Mid-Value", "Low-Value",
    ]


def test_line_amounts(spark):
    amounts = pricing.line_amounts(
        dec("3", "decimal(6,0)"), dec("19.9950", "decimal(12,4)"), dec("8.0001", "decimal(12,4)"),
        dec("5.0000", "decimal(12,4)"), dec("0.07", "decimal(4,2)"),
    )
    row = spark.range(1).select(*[c.alias(n) for n, c in amounts.items()]).first()
    assert row.gross_revenue == Decimal("59.9850")
    assert row.net_revenue == Decimal("54.9850")
    assert row.tax_amount == Decimal("3.8490")  # 3.84895 rounds half up
    assert row.cost_of_goods_sold == Decimal("24.0003")
    assert row.gross_margin == Decimal("30.9847")
    assert row.total_transaction_amount == Decimal("58.8340")


def test_margin_is_zero_without_revenue(spark):
    assert one(spark, pricing.margin_percent(dec("-5"), dec("0"))) == 0.0
    assert one(spark, pricing.margin_percent(dec("-5"), dec("-10"))) == 0.0


def test_promotion_discounts(spark):
    def discount(kind, value):
        return one(spark, pricing.promotion_discount(dec("80"), F.lit(kind), dec(value, "decimal(8,4)")))

    assert discount("PERCENT", "15") == Decimal("12.0000")
    assert discount("FIXED_AMOUNT", "100") == Decimal("80.0000")
    assert discount("FREE_GIFT", "100") == 0
    assert discount(None, "100") == 0


def test_promotion_end_and_status(spark):
    horizon = date(2024, 6, 30)
    end = promotions.clamped_end(F.lit(date(2024, 6, 20)), F.lit(30), horizon)
    assert one(spark, end) == horizon
    assert one(spark, promotions.status(end, horizon)) == "ACTIVE"
    assert one(spark, promotions.status(F.lit(date(2024, 6, 29)), horizon)) == "COMPLETED"


def test_currency(spark):
    assert one(spark, pricing.exchange_rate(F.lit("JPY"))) == Decimal("0.006700")
    assert one(spark, pricing.exchange_rate(F.lit("XXX"))) is None
    assert one(spark, pricing.line_currency(F.lit("AMER"), F.lit(0))) == "USD"
    assert one(spark, pricing.line_currency(F.lit("APAC"), F.lit(2))) == "USD"


def test_ratios_guard_and_round(spark):
    assert one(spark, ratios.ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, ratios.ratio(F.lit(1), F.lit(None))) is None
    exact_tie = ratios.ratio(dec("262652.785", "decimal(24,4)"), F.lit(277))
    assert one(spark, ratios.round_half_up(exact_tie, 2)) == 948.21


def test_fee_only_when_due(spark):
    def fee(condition, reason):
        return one(spark, returns.restocking_fee(dec("100"), F.lit(condition), F.lit(reason)))

    assert fee("SALEABLE", "SIZE") == 0
    assert fee("SALEABLE", "CHANGED_MIND") == 15
    assert fee("DAMAGED", "SIZE") == 15


def test_checksum_follows_tracked_values(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), ("a", "b")], "x STRING, y STRING")
    sums = [r.c for r in df.select(text.record_checksum(F.col("x"), F.col("y")).alias("c")).collect()]
    assert sums[0] == sums[1] != sums[2]


def test_ltv_bands_by_tier(spark):
    df = spark.createDataFrame([("Elite", 0), ("Elite", 99), ("Gold", 4), ("Silver", 60), (None, 94)], "t STRING, d INT")
    got = [r.b for r in df.select(customers.ltv_band(F.col("t"), F.col("d")).alias("b")).collect()]
    assert got == ["Mid", "VIP", "Low", "High", "High"]


def test_guest_row(spark):
    people = customers.build_dim_customer(
        spark.createDataFrame([(5, "Runner", "US", "US-1", "Town")],
                              "customer_sk BIGINT, customer_segment STRING, country_code STRING, state_code STRING, city STRING"),
        date(2024, 1, 1),
    )
    both = {r.customer_sk: r for r in customers.with_guest(people, date(2024, 1, 1)).collect()}
    assert both[0].customer_nk == params.GUEST_CUSTOMER_NK
    assert both[0].loyalty_tier is None
    assert both[5].customer_segment == "Runner"


def test_geography_parents_exist(spark):
    places = spark.createDataFrame(
        [("AMER", "Americas", "US", "United States", "CA", "Los Angeles"),
         ("AMER", "Americas", "US", "United States", "NY", "New York")],
        "region_code STRING, region_name STRING, country_code STRING, country_name STRING, state_code STRING, city STRING",
    )
    rows = stores.build_dim_geography(places).collect()
    keys = {r.geo_sk for r in rows}
    assert len(rows) == len(keys) == 6
    assert all(r.parent_geo_sk in keys for r in rows if r.geo_level != "REGION")
    assert {r.sub_region for r in rows if r.geo_level == "CITY"} == {"NORTH_AMERICA"}


def test_stock_is_carried_forward(spark):
    moves = spark.createDataFrame(
        [(1, 1, date(2024, 1, 10), 5, 0), (1, 1, date(2024, 3, 31), 0, 7), (2, 1, date(2024, 2, 15), 0, 3)],
        "product_sk BIGINT, store_sk BIGINT, move_date DATE, units_received BIGINT, units_sold BIGINT",
    )
    levels = inventory.stock_levels(moves, ["product_sk", "store_sk"], "move_date", 10, date(2024, 4, 15))
    got = sorted((r.product_sk, r.move_date, r.on_hand_qty, r.units_sold_today) for r in levels.collect())
    assert got == [
        (1, date(2024, 1, 31), 15, 0), (1, date(2024, 2, 29), 15, 0), (1, date(2024, 3, 31), 8, 7),
        (2, date(2024, 2, 29), 7, 0), (2, date(2024, 3, 31), 7, 0),
    ]
    weekly = inventory.snapshot_grid(moves, ["product_sk", "store_sk"], "move_date", date(2024, 1, 31), "week")
    assert sorted(r.move_date.day for r in weekly.collect()) == [10, 17, 24, 31]


def test_stock_health(spark):
    assert one(spark, inventory.stock_turn(inventory.days_of_supply(F.lit(0)))) == 0.0
    assert one(spark, inventory.days_of_supply(F.lit(5))) == 2.0
    assert one(spark, inventory.available(F.lit(-4), F.lit(0))) == 0
    assert one(spark, inventory.stockout(F.lit(0))) == "Y"


def clicks(spark, rows):
    schema = "visitor_id BIGINT, session_date DATE, event_id BIGINT, event_time TIMESTAMP, event_type STRING, amount DECIMAL(12,2)"
    from datetime import datetime

    return spark.createDataFrame(
        [(v, date(2024, 1, d), i, datetime(2024, 1, d, 10, i), k, Decimal(a)) for v, d, i, k, a in rows], schema
    )


def test_bounce_has_nothing_but_its_page(spark):
    df = clicks(spark, [(1, 1, 0, "purchase", "9.00")])
    row = sessions.session_funnel(df).first()
    assert row.bounce_flag and row.pages_viewed == 1
    assert not row.purchase_completed_flag and not row.checkout_initiated_flag
    assert row.entry_page == row.exit_page == "/purchase"


def test_conversion_is_cleared_when_sales_run_out(spark):
    rows = [(v, 1, i, k, "2.00") for v in (1, 2, 3) for i, k in enumerate(("view", "click", "purchase"))]
    sold = spark.createDataFrame([(date(2024, 1, 1), 70), (date(2024, 1, 1), 80), (date(2024, 1, 2), 90)],
                                 "transaction_date DATE, transaction_sk BIGINT")
    got = sessions.attribute_conversions(sessions.session_funnel(clicks(spark, rows)), sold).collect()
    linked = sorted(r.purchase_transaction_sk for r in got if r.purchase_completed_flag)
    assert linked == [70, 80]
    assert [r.purchase_revenue for r in got if not r.purchase_completed_flag] == [None]
