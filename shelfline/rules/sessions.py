"""Web sessions from click events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline import params
from shelfline.functions.dates import date_to_sk
from shelfline.functions.text import stable_key
from shelfline.operators.filters import pick
from shelfline.operators.joins import pair_in_order
from shelfline.rules.promotions import words

# Words of the session fact.
DEVICES = ("DESKTOP", "MOBILE", "TABLET", "APP")
HANDHELD_SYSTEMS = ("iOS", "Android")
DESKTOP_SYSTEMS = ("Windows", "MacOS", "Linux")
BROWSERS = ("Chrome", "Safari", "Firefox", "Edge", "Samsung Internet")
TRAFFIC_SOURCES = ("ORGANIC", "PAID", "EMAIL", "SOCIAL", "DIRECT", "REFERRAL", "AFFILIATE")


def operating_system(device: Column, number: Column) -> Column:
    return F.when(device == "DESKTOP", pick(words(DESKTOP_SYSTEMS), number)).otherwise(
        pick(words(HANDHELD_SYSTEMS), number)
    )


def browser(device: Column, number: Column) -> Column:
    """An app session has no browser."""
    return F.when(device != "APP", pick(words(BROWSERS), number))


def campaign(traffic: Column, number: Column) -> Column:
    """Only paid, mail and social traffic belongs to a campaign."""
    name = F.concat(F.lit("CMP-"), (F.pmod(number, F.lit(9000)) + 1000).cast("string"))
    return F.when(traffic.isin(*params.CAMPAIGN_TRAFFIC), name)


def session_funnel(events: DataFrame) -> DataFrame:
    """One row per visitor and day from (visitor_id, session_date, event_id,
    event_time, event_type, amount). A session with one page is a bounce and
    has nothing else."""
    kind = F.col("event_type")
    moment = F.struct("event_time", "event_id")
    cart = F.sum(F.when(kind == "click", F.col("amount"))).cast("decimal(12,4)")
    counted = events.groupBy("visitor_id", "session_date").agg(
        F.count(F.lit(1)).alias("pages_viewed"),
        F.count_if(kind == "view").alias("_views"),
        F.count_if(kind == "click").alias("_adds"),
        F.count_if(kind == "purchase").alias("_buys"),
        F.coalesce(cart, F.lit(0).cast("decimal(12,4)")).alias("_cart"),
        (F.unix_micros(F.max("event_time")) - F.unix_micros(F.min("event_time"))).alias("_micros"),
        F.concat(F.lit("/"), F.min_by(kind, moment)).alias("entry_page"),
        F.concat(F.lit("/"), F.max_by(kind, moment)).alias("_last_page"),
    )
    bounce = F.col("pages_viewed") == 1
    stays = ~bounce

    def unless_bounced(value: Column, otherwise: object = 0) -> Column:
        return F.when(stays, value).otherwise(otherwise)

    return counted.select(
        stable_key(F.col("visitor_id"), F.col("session_date")).alias("session_sk"),
        "visitor_id",
        "session_date",
        date_to_sk(F.col("session_date")).alias("session_date_sk"),
        F.floor(F.col("_micros") / 1000000).cast("int").alias("session_duration_seconds"),
        "pages_viewed",
        unless_bounced(F.col("_views")).alias("products_viewed"),
        unless_bounced(F.col("_adds")).alias("products_added_to_cart"),
        unless_bounced(F.col("_cart"), F.lit(0).cast("decimal(12,4)")).alias("cart_value"),
        (stays & ((F.col("_adds") > 0) | (F.col("_buys") > 0))).alias("checkout_initiated_flag"),
        (stays & (F.col("_buys") > 0)).alias("purchase_completed_flag"),
        bounce.alias("bounce_flag"),
        "entry_page",
        F.when(bounce, F.col("entry_page")).otherwise(F.col("_last_page")).alias("exit_page"),
    )


def attribute_conversions(sessions: DataFrame, digital_sales: DataFrame) -> DataFrame:
    """Link the n-th converting session of a day to the n-th digital sale of that
    day. When the sales run out, the session no longer counts as converted."""
    sold = digital_sales.select(
        F.col("transaction_date").alias("session_date"), F.col("transaction_sk").alias("purchase_transaction_sk")
    )
    linked = pair_in_order(
        sessions, sold, "session_date", "session_sk", "purchase_transaction_sk", takes_part="purchase_completed_flag"
    )
    found = F.col("purchase_transaction_sk").isNotNull()
    return linked.withColumns(
        {
            "purchase_completed_flag": found,
            "purchase_revenue": F.when(found, F.col("cart_value").cast("decimal(14,4)")),
        }
    )


def build_fact_web_sessions(events: DataFrame, digital_sales: DataFrame) -> DataFrame:
    sessions = attribute_conversions(session_funnel(events), digital_sales)
    visitor = F.col("visitor_id")
    device = pick(words(DEVICES), visitor)
    traffic = pick(words(TRAFFIC_SOURCES), visitor)
    return sessions.withColumns(
        {
            "session_id": F.concat_ws("-", visitor.cast("string"), F.col("session_date_sk").cast("string")),
            "customer_sk": F.when(F.pmod(visitor, F.lit(5)) < 2, visitor),
            "channel_sk": pick(words(params.DIGITAL_CHANNELS), visitor),
            "device_type": device,
            "os_platform": operating_system(device, visitor),
            "browser_name": browser(device, visitor),
            "traffic_source": traffic,
            "campaign_id": campaign(traffic, visitor),
        }
    ).drop("visitor_id")
