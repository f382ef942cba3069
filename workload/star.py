"""The retail star derived from order, part, supplier and event tables.

The source tables have no stores, promotions or returns, so keys stand in for
what a retailer's systems would record: a supplier is a store, a part is a
product, and key arithmetic picks channels, reasons and the like.
"""

from __future__ import annotations

from datetime import date
from decimal import Decimal
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.functions.dates import date_to_sk, period_start
from shelfline.functions.text import split_first, stable_key
from shelfline.metrics.model import Sources
from shelfline.operators.filters import admissible_channels, pick
from shelfline.operators.joins import large_inner, many_to_one
from shelfline.operators.sizing import broadcast_if_small
from shelfline.rules import calendar, customers, inventory, products, promotions, returns, sales, sessions, stores
from shelfline.schemas import TABLES
from shelfline.sources.readers import read_parquet
from shelfline.sources.scratch import stored
from shelfline.sources.writers import conform

TIERS = ((Decimal("30000"), "High-Value"), (Decimal("10000"), "Mid-Value"))
OPENING_STOCK = 100
# Events are dated 2024; moved back 25 years they fall among the sales.
EVENT_SHIFT_DAYS = 9131

# What the load sets itself, and when the load of these tests took place.
LOAD_TIMES = ("load_timestamp", "created_timestamp", "updated_timestamp")
LOADED_AT = "TIMESTAMP '2024-01-01 00:00:00'"

RAW_SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
                "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}

PART_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")


def _mod(column: str, by: int) -> Column:
    return F.pmod(F.col(column), F.lit(by))


def store_type(sk: Column) -> Column:
    return pick(promotions.words(("ECOM", "PARTNER", "CONCEPT", "FLAGSHIP", "FACTORY")), sk)


def store_format(sk: Column) -> Column:
    return pick(promotions.words(("DIGITAL", "FULL_LINE", "SPORT", "RUN", "BASKETBALL")), sk)


def channel_type(sk: Column) -> Column:
    kinds = ("ECOMMERCE", "WHOLESALE", "WHOLESALE", "BRICK_MORTAR", "BRICK_MORTAR")
    return pick(promotions.words(kinds), sk)


def stock_item(brand: Column, part_type: Column) -> Column:
    """Key from 1 to 150 of a brand and type."""
    brand_number = F.substring_index(brand, "#", -1).cast("bigint")
    place = F.array_position(F.array(*[F.lit(t) for t in PART_TYPES]), part_type)
    return (brand_number - 1) * len(PART_TYPES) + place


class Star:
    """Lazy frames of the star over one folder of source tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        schema = T.StructType.fromDDL(RAW_SCHEMAS[name])
        return read_parquet(self.spark, f"{self.folder}/{name}.parquet", schema)

    # --- the span of the data --------------------------------------------------
    # Dates as one-row subqueries: a query that needs one computes it, and only then.

    def _date_of(self, table: str, value: Column) -> Column:
        return self.raw(table).agg(F.coalesce(value.cast("date"), F.lit(date(1970, 1, 1)))).scalar()

    @cached_property
    def epoch(self) -> Column:
        """First day of the year of the first order."""
        return F.trunc(self._date_of("orders", F.min("o_orderdate")), "year")

    @cached_property
    def horizon(self) -> Column:
        """Day of the last order; what would come back later has not come back yet."""
        return self._date_of("orders", F.max("o_orderdate"))

    @cached_property
    def calendar_end(self) -> Column:
        """Last day of the year of the last order or shipment."""
        last = F.greatest(self.horizon, self._date_of("lineitem", F.max("l_shipdate")))
        return F.date_sub(F.add_months(F.trunc(last, "year"), 12), 1)

    # --- dimensions ----------------------------------------------------------

    def dates(self, *columns: str) -> DataFrame:
        days = F.sequence(self.epoch, self.calendar_end, F.expr("interval 1 day"))
        return calendar.build_dim_date(self.spark.range(1).select(F.explode(days).alias("date_day")), *columns)

    def places(self) -> DataFrame:
        """Country and region of each nation key; both source tables have fixed size."""
        nation, region = self.raw("nation"), self.raw("region")
        region_code = (
            F.when(F.col("r_name") == "AMERICA", "AMER").when(F.col("r_name") == "ASIA", "APAC").otherwise("EMEA")
        )
        return nation.join(broadcast_if_small(region), F.col("n_regionkey") == F.col("r_regionkey"), "left").select(
            "n_nationkey",
            F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("country_code"),
            F.col("n_name").alias("country_name"),
            region_code.alias("region_code"),
            F.col("r_name").alias("region_name"),
        )

    def _located(self, df: DataFrame, nation_key: str, number: str) -> DataFrame:
        """Add country, state and city; cities 0 to 5 of a country lie in states 0 to 2."""
        state = F.concat(F.col("country_code"), F.lit("-S"), _mod(number, 3).cast("string"))
        city = F.concat(F.lit("City "), F.col("country_code"), F.lit("-"), _mod(number, 6).cast("string"))
        placed = many_to_one(df, self.places(), nation_key, "n_nationkey")
        return placed.withColumns({"state_code": state, "city": city})

    def raw_stores(self) -> DataFrame:
        sk = F.col("s_suppkey")
        return self._located(self.raw("supplier"), "s_nationkey", "s_suppkey").select(
            sk.alias("store_sk"),
            F.col("s_name").alias("base_name"),
            store_type(sk).alias("store_type"),
            store_format(sk).alias("store_format"),
            channel_type(sk).alias("channel_type"),
            "region_code", "region_name", "country_code", "country_name", "state_code", "city",
        )

    def stores(self, *columns: str) -> DataFrame:
        return stores.build_dim_store(self.raw_stores(), self.epoch, columns)

    def raw_products(self) -> DataFrame:
        kind = F.when(F.col("p_type").isin("SMALL", "MEDIUM"), "FW").when(
            F.col("p_type").isin("LARGE", "STANDARD"), "AP"
        ).otherwise("EQ")
        return self.raw("part").select(
            F.col("p_partkey").alias("product_sk"),
            kind.alias("kind"),
            F.col("p_type").alias("division_name"),
            F.col("p_brand").alias("category_name"),
            F.concat(F.lit("Size "), F.col("p_size").cast("string")).alias("subcategory_name"),
            F.element_at(F.split("p_name", " "), 2).alias("product_line_name"),
            F.concat(F.element_at(F.split("p_name", " "), 1), F.lit("/"), F.lower("p_type")).alias("colorway"),
            F.col("p_retailprice").cast("decimal(12,2)").alias("base_price"),
            (_mod("p_partkey", 16) + 35).alias("cost_percent"),
        )

    def products(self, *columns: str) -> DataFrame:
        return products.build_dim_product(self.raw_products(), self.epoch, columns)

    def prices(self) -> DataFrame:
        return self.products("product_sk", "standard_retail_price", "standard_cost").select(
            "product_sk",
            F.col("standard_retail_price").alias("unit_retail_price"),
            F.col("standard_cost").alias("unit_cost_price"),
        )

    def customers(self, *columns: str) -> DataFrame:
        placed = self._located(self.raw("customer"), "c_nationkey", "c_custkey")
        raw = placed.select(
            F.col("c_custkey").alias("customer_sk"), F.col("c_mktsegment").alias("customer_segment"),
            "country_code", "state_code", "city",
        )
        return customers.build_dim_customer(raw, self.epoch, columns)

    def employees(self) -> DataFrame:
        return stores.build_dim_employee(self.stores("store_sk", "is_digital"), self.epoch)

    def promotions(self) -> DataFrame:
        sk = F.col("promotion_sk")
        raw = self.raw("part").select(
            stock_item(F.col("p_brand"), F.col("p_type")).alias("promotion_sk"), F.col("p_brand").alias("category_name")
        ).distinct()
        return promotions.build_dim_promotion(
            raw.select(
                sk,
                F.date_add(F.lit(self.epoch), (sk * 16).cast("int")).alias("start_date"),
                (F.pmod(sk, F.lit(38)) + 7).cast("int").alias("duration_days"),
                "category_name",
            ),
            self.horizon,
        )

    # --- sales and returns -----------------------------------------------------

    def lines(self, *columns: str, returned_only: bool = False) -> DataFrame:
        """Ticket lines with keys and rates, before pricing; all columns or the named ones."""
        lineitem = self.raw("lineitem")
        if returned_only:  # on the stored column, so that the scan skips the rest
            lineitem = lineitem.where("l_returnflag = 'R'")
        orders = self.raw("orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("_day"))
        joined = large_inner(lineitem, orders, "l_orderkey", "o_orderkey")
        order, store, day = F.col("l_orderkey"), F.col("l_suppkey"), F.col("_day")
        quantity = F.col("l_quantity").cast("decimal(6,0)")
        digital = F.pmod(store, F.lit(5)) == 0

        def line_key() -> Column:
            cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
            return stable_key(order, F.col("l_linenumber"), F.col("l_partkey"), store, cents)

        def natural_key() -> Column:
            return F.concat_ws("-", order, F.col("l_linenumber"), F.col("l_partkey"), store, F.round(F.col("l_extendedprice") * 100).cast("bigint"))

        def staff() -> Column:
            return F.when(~digital, store * 100 + 1 + F.pmod(order, F.pmod(store, F.lit(11)) + 5))

        known = {
            "transaction_sk": line_key,
            "transaction_nk": natural_key,
            "transaction_id": lambda: order.cast("string"),
            "line_number": lambda: F.col("l_linenumber"),
            "transaction_date": lambda: day,
            "transaction_date_sk": lambda: date_to_sk(day),
            "transaction_year": lambda: period_start(day, "year"),
            "customer_sk": lambda: F.when(_mod("o_custkey", 5) != 0, F.col("o_custkey")),
            "product_sk": lambda: F.col("l_partkey"),
            "store_sk": lambda: store,
            "channel_sk": lambda: pick(admissible_channels(digital, channel_type(store)), order),
            "promotion_sk": lambda: F.when(_mod("l_orderkey", 10) < 3, _mod("l_orderkey", 150) + 1),
            "employee_sk": staff,
            "quantity_sold": lambda: quantity,
            "discount_rate": lambda: F.col("l_discount").cast("decimal(4,2)"),
            "tax_rate": lambda: F.col("l_tax").cast("decimal(4,2)"),
            "return_flag": lambda: F.when(F.col("l_returnflag") == "R", "Y").otherwise("N"),
            "order_number": lambda: order,
            "return_delay": lambda: (_mod("l_orderkey", 40) + 5).cast("int"),
            "quantity_returned": lambda: (F.pmod(order, quantity.cast("bigint")) + 1).cast("int"),
        }
        return joined.select(*[known[c]().alias(c) for c in columns or [c for c in known if c != "transaction_nk"]])

    def sales(self, *columns: str, carried: dict[str, list[str]] | None = None) -> DataFrame:
        """Columns of the sales fact, optionally with attributes of product and store."""
        wanted = columns or (*sales.LINE_COLUMNS, *sales.PRICE_COLUMNS, *sales.STORE_COLUMNS, *sales.USD_COLUMNS)
        carried = carried or {}
        lines = self.lines(*sales.needed_line_columns(wanted, carried))
        return sales.sales_columns(
            lines, lambda c: self.products(*c), lambda c: self.stores(*c), wanted, TIERS,
            carried.get("product", ()), carried.get("store", ()),
        )

    def star_sales(self, *columns: str, product: tuple[str, ...] = (), store: tuple[str, ...] = ()) -> DataFrame:
        """Sales with attributes of product and store under their own names, without
        sales of unknown products or stores."""
        carried = {e: list(a) for e, a in (("product", product), ("store", store)) if a}
        named = {f"_{e}_{a}": a for e, attributes in carried.items() for a in attributes}
        found = [F.col(f"_{e}_{attributes[0]}").isNotNull() for e, attributes in carried.items()]
        return self.sales(*columns, carried=carried).where(reduce(Column.__and__, found)).withColumnsRenamed(named)

    def _store_facts(self) -> DataFrame:
        return self.stores("store_sk", "region_code", "is_digital")

    def promoted_sales(self) -> DataFrame:
        return sales.build_fact_sales(self.lines(), self.prices(), self._store_facts(), self.promotions())

    def returned_lines(self, *more: str) -> DataFrame:
        back = self.lines(
            "transaction_sk", "transaction_date", "transaction_date_sk", "customer_sk", "product_sk", "store_sk",
            "channel_sk", "return_flag", "order_number", "return_delay", "quantity_returned", *more, returned_only=True,
        )
        return many_to_one(back, self.prices(), "product_sk")

    def returns(self, *columns: str) -> DataFrame:
        natural = ["transaction_nk"] if "original_transaction_nk" in columns else []
        built = returns.build_fact_returns(self.returned_lines(*natural), self.horizon)
        return built.select(*columns) if columns else built

    # --- sessions ----------------------------------------------------------------

    def clicks(self) -> DataFrame:
        return self.raw("events").select(
            F.col("user_id").alias("visitor_id"),
            F.date_sub(F.col("ts").cast("date"), EVENT_SHIFT_DAYS).alias("session_date"),
            "event_id",
            F.col("ts").cast("timestamp").alias("event_time"),
            "event_type",
            F.col("value").cast("decimal(12,2)").alias("amount"),
        )

    def digital_sales(self) -> DataFrame:
        return self.sales("transaction_sk", "transaction_date", "channel_sk").where(F.col("channel_sk").isin(2, 3, 4))

    def funnels(self) -> DataFrame:
        return sessions.session_funnel(self.clicks())

    def sessions(self) -> DataFrame:
        return sessions.build_fact_web_sessions(self.clicks(), self.digital_sales())

    # --- inventory -----------------------------------------------------------------

    def items(self) -> DataFrame:
        """Stock-keeping items: one per brand and type, with the lowest unit values."""
        priced = self.products("product_sk", "category_name", "division_name", "standard_cost", "standard_retail_price")
        item = stock_item(F.col("category_name"), F.col("division_name"))
        return priced.where(item.isNotNull()).groupBy(item.alias("product_sk")).agg(
            F.min("category_name").alias("category_name"),
            F.min("division_name").alias("subcategory_name"),
            F.min("standard_cost").alias("unit_cost"),
            F.min("standard_retail_price").alias("unit_retail"),
        )

    def sites(self) -> DataFrame:
        """Warehouses: one per country."""
        return self.places().select(F.col("n_nationkey").cast("bigint").alias("store_sk"), "region_name")

    def movements(self) -> DataFrame:
        """Units received and sold per item, site and day."""
        item = self.raw("part").select("p_partkey", stock_item(F.col("p_brand"), F.col("p_type")).alias("_item"))
        site = self.raw("supplier").select("s_suppkey", F.col("s_nationkey").cast("bigint").alias("_site"))
        lines = self.raw("lineitem").select("l_partkey", "l_suppkey", "l_quantity", "l_linestatus", "l_shipdate")
        placed = many_to_one(
            many_to_one(lines, item, "l_partkey", "p_partkey", "inner"), site, "l_suppkey", "s_suppkey", "inner"
        )
        units = F.col("l_quantity").cast("bigint")
        return placed.groupBy(
            F.col("_item").alias("product_sk"), F.col("_site").alias("store_sk"),
            F.col("l_shipdate").cast("date").alias("move_date"),
        ).agg(
            F.coalesce(F.sum(F.when(F.col("l_linestatus") == "O", units)), F.lit(0)).alias("units_received"),
            F.coalesce(F.sum(F.when(F.col("l_linestatus") == "F", units)), F.lit(0)).alias("units_sold"),
        )

    def levels(self, every: str = "month") -> DataFrame:
        return inventory.stock_levels(
            self.movements(), ["product_sk", "store_sk"], "move_date", OPENING_STOCK, self.calendar_end, every
        )

    def inventory(self, every: str = "month") -> DataFrame:
        valued = self.items().select("product_sk", "unit_cost", "unit_retail")
        stocked = many_to_one(self.levels(every), valued, "product_sk", how="inner", guarded=False)
        return inventory.build_inventory_snapshot(stocked, "move_date")

    def stored_inventory(self, partition_by: str = "snapshot_date_sk") -> DataFrame:
        """The snapshot as a table with one partition per date."""
        return stored(self.inventory(), "inventory", [partition_by])

    # --- declared tables -------------------------------------------------------------

    def declared(self, table: str) -> DataFrame:
        """One of the twelve tables with all declared columns and types, as of one time of load."""
        build = {
            "fact_sales_transactions": self.promoted_sales, "fact_inventory_snapshot": self.inventory, "fact_returns": self.returns,
            "fact_web_sessions": self.sessions, "dim_customer": self.customers, "dim_promotion": self.promotions,
            "dim_product": self.products, "dim_store": self.stores, "dim_date": self.dates, "dim_employee": self.employees,
            "dim_channel": lambda: stores.build_dim_channel(self.spark), "dim_geography": lambda: stores.build_dim_geography(self.raw_stores()),
        }
        return conform(build[table](), TABLES[table], {c: F.expr(LOADED_AT) for c in LOAD_TIMES})

    # --- metric layers ---------------------------------------------------------------

    def metric_sources(self) -> Sources:
        """Prices come from the product table and currencies from the store table,
        so the fact carries the attributes of both. Lines meet orders by the order's
        number, of which the transaction's id is the text."""
        return Sources(
            fact=lambda columns, carried=None: self.sales(*columns, carried=carried),
            entities={
                "store": lambda c: self.stores(*c),
                "product": lambda c: self.products(*c),
                "customer": lambda c: self.customers(*c),
            },
            carried=frozenset({"product", "store"}),
            counted_by={"transaction_id": "order_number"},
        )
