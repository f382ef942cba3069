"""Declared schemas of the star: four facts and eight dimensions."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class TableSpec:
    """A table's columns, layout and the constraints that quality checks test."""

    name: str
    columns: str
    primary_key: str
    partition_by: tuple[str, ...] = ()
    defaults: dict[str, str] = field(default_factory=dict)
    allowed: dict[str, tuple[str, ...]] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        """The Spark schema; needs an active session."""
        return T.StructType.fromDDL(self.columns)

    @property
    def _declarations(self) -> list[list[str]]:
        return [d.split() for d in re.split(r",(?![^(]*\))", self.columns)]

    @property
    def column_names(self) -> list[str]:
        return [d[0] for d in self._declarations]

    @property
    def types(self) -> dict[str, str]:
        """Declared type of each column."""
        return {d[0]: d[1] for d in self._declarations}

    @property
    def required(self) -> list[str]:
        return [d[0] for d in self._declarations if d[-2:] == ["NOT", "NULL"]]


NOW = "current_timestamp()"
FOREVER = "DATE'9999-12-31'"

# Table and column names, types, defaults and value sets below
# are the data model's public contract.
_SPECS = (
    TableSpec(
        "fact_sales_transactions",
        """
        transaction_sk BIGINT, transaction_id STRING NOT NULL, line_number SMALLINT NOT NULL,
        transaction_date_sk INT NOT NULL, customer_sk BIGINT, product_sk BIGINT NOT NULL,
        store_sk INT NOT NULL, channel_sk SMALLINT NOT NULL, promotion_sk INT, employee_sk INT,
        quantity_sold SMALLINT NOT NULL, unit_retail_price DECIMAL(12,4) NOT NULL,
        unit_cost_price DECIMAL(12,4) NOT NULL, gross_revenue DECIMAL(14,4) NOT NULL,
        discount_amount DECIMAL(12,4) NOT NULL, net_revenue DECIMAL(14,4) NOT NULL,
        tax_amount DECIMAL(12,4) NOT NULL, total_transaction_amount DECIMAL(14,4) NOT NULL,
        cost_of_goods_sold DECIMAL(14,4) NOT NULL, gross_margin DECIMAL(14,4) NOT NULL,
        gross_margin_pct DECIMAL(7,4), return_flag STRING NOT NULL, currency_code STRING NOT NULL,
        exchange_rate DECIMAL(10,6) NOT NULL, net_revenue_usd DECIMAL(14,4) NOT NULL,
        load_timestamp TIMESTAMP NOT NULL, source_system STRING NOT NULL
        """,
        primary_key="transaction_sk",
        partition_by=("transaction_date_sk",),
        defaults={
            "quantity_sold": "1", "discount_amount": "0", "tax_amount": "0", "return_flag": "'N'",
            "currency_code": "'USD'", "exchange_rate": "1.0", "load_timestamp": NOW,
        },
    ),
    TableSpec(
        "fact_inventory_snapshot",
        """
        inventory_sk BIGINT, snapshot_date_sk INT NOT NULL, product_sk BIGINT NOT NULL,
        store_sk INT NOT NULL, on_hand_qty INT NOT NULL, in_transit_qty INT NOT NULL,
        on_order_qty INT NOT NULL, reserved_qty INT NOT NULL, available_to_sell_qty INT NOT NULL,
        units_received_today INT NOT NULL, units_sold_today INT NOT NULL,
        units_returned_today INT NOT NULL, units_shrinkage_today INT NOT NULL,
        inventory_cost_value DECIMAL(16,4) NOT NULL, inventory_retail_value DECIMAL(16,4) NOT NULL,
        reorder_point INT, days_of_supply DECIMAL(8,2), stock_turn_rate DECIMAL(8,4),
        stockout_flag STRING NOT NULL, load_timestamp TIMESTAMP NOT NULL
        """,
        primary_key="inventory_sk",
        partition_by=("snapshot_date_sk",),
        defaults={
            "on_hand_qty": "0", "in_transit_qty": "0", "on_order_qty": "0", "reserved_qty": "0",
            "available_to_sell_qty": "0", "units_received_today": "0", "units_sold_today": "0",
            "units_returned_today": "0", "units_shrinkage_today": "0", "inventory_cost_value": "0",
            "inventory_retail_value": "0", "stockout_flag": "'N'", "load_timestamp": NOW,
        },
    ),
    TableSpec(
        "dim_customer",
        """
        customer_sk BIGINT, customer_nk STRING NOT NULL, first_name STRING, last_name STRING,
        email_address_hash STRING, phone_hash STRING, date_of_birth_sk INT, gender_code STRING,
        loyalty_member_flag BOOLEAN NOT NULL, loyalty_tier STRING, loyalty_points_balance INT,
        loyalty_enroll_date_sk INT, customer_segment STRING, preferred_sport STRING,
        lifetime_value_band STRING, acquisition_channel STRING, city STRING, state_province STRING,
        country_code STRING, postal_code STRING, effective_date DATE NOT NULL,
        expiry_date DATE NOT NULL, is_current_flag BOOLEAN NOT NULL, record_checksum STRING,
        created_timestamp TIMESTAMP NOT NULL, updated_timestamp TIMESTAMP NOT NULL
        """,
        primary_key="customer_sk",
        defaults={
            "loyalty_member_flag": "false", "loyalty_points_balance": "0", "expiry_date": FOREVER,
            "is_current_flag": "true", "created_timestamp": NOW, "updated_timestamp": NOW,
        },
    ),
    TableSpec(
        "dim_promotion",
        """
        promotion_sk INT, promotion_nk STRING NOT NULL, promotion_name STRING NOT NULL,
        promotion_type STRING, discount_type STRING, discount_value DECIMAL(8,4),
        min_purchase_amount DECIMAL(12,4), max_discount_cap DECIMAL(12,4), campaign_name STRING,
        campaign_category STRING, marketing_channel STRING, start_date_sk INT NOT NULL,
        end_date_sk INT NOT NULL, applicable_product_category STRING,
        applicable_store_region STRING, applicable_channel STRING, stackable_flag BOOLEAN NOT NULL,
        estimated_cost DECIMAL(16,4), actual_cost DECIMAL(16,4), funded_by STRING,
        promotion_status STRING NOT NULL, created_timestamp TIMESTAMP NOT NULL,
        updated_timestamp TIMESTAMP NOT NULL
        """,
        primary_key="promotion_sk",
        defaults={
            "stackable_flag": "false", "promotion_status": "'ACTIVE'",
            "created_timestamp": NOW, "updated_timestamp": NOW,
        },
        allowed={"discount_type": ("PERCENT", "FIXED_AMOUNT", "FREE_GIFT")},
    ),
    TableSpec(
        "dim_product",
        """
        product_sk BIGINT NOT NULL, product_nk STRING NOT NULL, upc_code STRING,
        division_code STRING NOT NULL, division_name STRING NOT NULL, category_code STRING NOT NULL,
        category_name STRING NOT NULL, subcategory_code STRING NOT NULL,
        subcategory_name STRING NOT NULL, product_line_code STRING NOT NULL,
        product_line_name STRING NOT NULL, product_name STRING NOT NULL, product_description STRING,
        style_code STRING, colorway STRING, size STRING, gender_target STRING, age_group STRING,
        material_composition STRING, technology_features STRING, sport_occasion STRING,
        is_hero_product BOOLEAN, is_exclusive BOOLEAN, is_collaboration BOOLEAN,
        collab_partner STRING, standard_cost DECIMAL(12,4), standard_retail_price DECIMAL(12,4),
        launch_date_sk INT, discontinue_date_sk INT, is_active BOOLEAN,
        effective_date DATE NOT NULL, expiry_date DATE NOT NULL, is_current_flag BOOLEAN,
        created_timestamp TIMESTAMP NOT NULL, updated_timestamp TIMESTAMP NOT NULL
        """,
        primary_key="product_sk",
        partition_by=("division_code",),
        defaults={
            "is_hero_product": "false", "is_exclusive": "false", "is_collaboration": "false",
            "is_active": "true", "expiry_date": FOREVER, "is_current_flag": "true",
            "created_timestamp": NOW, "updated_timestamp": NOW,
        },
        allowed={
            "gender_target": ("MENS", "WOMENS", "UNISEX", "KIDS"),
            "age_group": ("ADULT", "YOUTH", "TODDLER"),
        },
    ),
    TableSpec(
        "dim_store",
        """
        store_sk INT NOT NULL, store_nk STRING NOT NULL, store_name STRING NOT NULL,
        store_type STRING NOT NULL, region_code STRING NOT NULL, region_name STRING NOT NULL,
        country_code STRING NOT NULL, country_name STRING NOT NULL, state_province_code STRING,
        state_province_name STRING, metro_market STRING, city STRING, store_address STRING,
        postal_code STRING, latitude DECIMAL(10,7), longitude DECIMAL(10,7), square_footage INT,
        num_floors SMALLINT, store_format STRING, channel_type STRING, is_digital BOOLEAN,
        open_date_sk INT, close_date_sk INT, is_active BOOLEAN, store_manager_employee_sk INT,
        ownership_model STRING, partner_account_id STRING, created_timestamp TIMESTAMP NOT NULL
        """,
        primary_key="store_sk",
        partition_by=("region_code",),
        defaults={"is_digital": "false", "is_active": "true", "created_timestamp": NOW},
        allowed={
            "store_type": ("FLAGSHIP", "FACTORY", "CONCEPT", "PARTNER", "ECOM"),
            "region_code": ("AMER", "EMEA", "APAC"),
            "store_format": ("FULL_LINE", "SPORT", "RUN", "BASKETBALL"),
            "channel_type": ("BRICK_MORTAR", "ECOMMERCE", "WHOLESALE", "APP"),
            "ownership_model": ("OWNED", "FRANCHISE", "PARTNER", "DIRECT"),
        },
    ),
    TableSpec(
        "dim_date",
        """
        date_sk INT NOT NULL, full_date DATE NOT NULL, day_of_week_num TINYINT NOT NULL,
        day_of_week_name STRING NOT NULL, day_of_week_abbr STRING NOT NULL,
        day_of_month TINYINT NOT NULL, day_of_year SMALLINT NOT NULL, week_of_year TINYINT NOT NULL,
        iso_week_number TINYINT NOT NULL, month_num TINYINT NOT NULL, month_name STRING NOT NULL,
        month_abbr STRING NOT NULL, month_year STRING NOT NULL, quarter_num TINYINT NOT NULL,
        quarter_name STRING NOT NULL, year_num SMALLINT NOT NULL, first_day_of_month DATE NOT NULL,
        last_day_of_month DATE NOT NULL, first_day_of_quarter DATE NOT NULL,
        last_day_of_quarter DATE NOT NULL, fiscal_week_num TINYINT, fiscal_month_num TINYINT,
        fiscal_quarter_num TINYINT, fiscal_year_num SMALLINT, fiscal_quarter_name STRING,
        retail_period_num TINYINT, retail_week_num SMALLINT, retail_year_num SMALLINT,
        is_weekday BOOLEAN NOT NULL, is_weekend BOOLEAN NOT NULL, is_holiday BOOLEAN NOT NULL,
        holiday_name STRING, is_black_friday BOOLEAN NOT NULL, is_cyber_monday BOOLEAN NOT NULL,
        is_back_to_school BOOLEAN NOT NULL, season STRING
        """,
        primary_key="date_sk",
        defaults={
            "is_holiday": "false", "is_black_friday": "false", "is_cyber_monday": "false",
            "is_back_to_school": "false",
        },
        allowed={"season": ("SPRING", "SUMMER", "FALL", "HOLIDAY")},
    ),
    TableSpec(
        "dim_channel",
        """
        channel_sk SMALLINT NOT NULL, channel_nk STRING NOT NULL, channel_name STRING NOT NULL,
        channel_category STRING NOT NULL, channel_type STRING NOT NULL, is_digital BOOLEAN NOT NULL,
        is_owned BOOLEAN NOT NULL, platform_name STRING
        """,
        primary_key="channel_sk",
        defaults={"is_digital": "false", "is_owned": "false"},
        allowed={
            "channel_category": ("DIRECT", "WHOLESALE", "MARKETPLACE"),
            "channel_type": ("STORE", "WEB", "APP", "PHONE", "WHOLESALE"),
        },
    ),
    TableSpec(
        "dim_employee",
        """
        employee_sk INT NOT NULL, employee_nk STRING NOT NULL, full_name_hash STRING,
        job_title STRING, department STRING, store_sk INT, hire_date_sk INT,
        termination_date_sk INT, is_active BOOLEAN, effective_date DATE NOT NULL,
        expiry_date DATE NOT NULL, is_current_flag BOOLEAN
        """,
        primary_key="employee_sk",
        defaults={"is_active": "true", "expiry_date": FOREVER, "is_current_flag": "true"},
    ),
    TableSpec(
        # The key is BIGINT because it is hashed from the level and code.
        "dim_geography",
        """
        geo_sk BIGINT NOT NULL, geo_level STRING NOT NULL, geo_code STRING NOT NULL,
        geo_name STRING NOT NULL, parent_geo_sk BIGINT, world_region STRING, sub_region STRING,
        country_code STRING, country_name STRING, state_code STRING, state_name STRING,
        metro_market STRING, city STRING, population BIGINT, gdp_per_capita_usd DECIMAL(14,2),
        market_priority STRING
        """,
        primary_key="geo_sk",
        allowed={
            "geo_level": ("REGION", "COUNTRY", "STATE", "METRO", "CITY"),
            "market_priority": ("TIER_1", "TIER_2", "TIER_3"),
        },
    ),
    TableSpec(
        "fact_returns",
        """
        return_sk BIGINT NOT NULL, return_id STRING NOT NULL, return_line_number SMALLINT NOT NULL,
        return_date_sk INT NOT NULL, original_transaction_sk BIGINT,
        original_transaction_date_sk INT, customer_sk BIGINT, product_sk BIGINT NOT NULL,
        store_sk INT NOT NULL, channel_sk SMALLINT NOT NULL, return_reason_code STRING,
        return_reason_desc STRING, return_condition STRING, quantity_returned SMALLINT NOT NULL,
        return_retail_amount DECIMAL(14,4) NOT NULL, return_cost_amount DECIMAL(14,4) NOT NULL,
        refund_amount DECIMAL(14,4) NOT NULL, restocking_fee DECIMAL(10,4) NOT NULL,
        return_shipping_cost DECIMAL(10,4) NOT NULL, days_since_purchase SMALLINT,
        is_within_return_window BOOLEAN NOT NULL, load_timestamp TIMESTAMP NOT NULL
        """,
        primary_key="return_sk",
        partition_by=("return_date_sk",),
        defaults={
            "restocking_fee": "0", "return_shipping_cost": "0",
            "is_within_return_window": "true", "load_timestamp": NOW,
        },
        allowed={"return_condition": ("SALEABLE", "DAMAGED", "DEFECTIVE")},
    ),
    TableSpec(
        "fact_web_sessions",
        """
        session_sk BIGINT NOT NULL, session_id STRING NOT NULL, session_date_sk INT NOT NULL,
        customer_sk BIGINT, channel_sk SMALLINT, device_type STRING, os_platform STRING,
        browser_name STRING, entry_page STRING, exit_page STRING, traffic_source STRING,
        campaign_id STRING, session_duration_seconds INT, pages_viewed SMALLINT,
        products_viewed SMALLINT, products_added_to_cart SMALLINT, cart_value DECIMAL(12,4),
        checkout_initiated_flag BOOLEAN NOT NULL, purchase_completed_flag BOOLEAN NOT NULL,
        purchase_transaction_sk BIGINT, purchase_revenue DECIMAL(14,4), bounce_flag BOOLEAN NOT NULL,
        load_timestamp TIMESTAMP NOT NULL
        """,
        primary_key="session_sk",
        partition_by=("session_date_sk",),
        defaults={
            "checkout_initiated_flag": "false", "purchase_completed_flag": "false",
            "bounce_flag": "false", "load_timestamp": NOW,
        },
        allowed={
            "device_type": ("DESKTOP", "MOBILE", "TABLET", "APP"),
            "traffic_source": ("ORGANIC", "PAID", "EMAIL", "SOCIAL", "DIRECT", "REFERRAL", "AFFILIATE"),
        },
    ),
)

TABLES: dict[str, TableSpec] = {spec.name: spec for spec in _SPECS}
