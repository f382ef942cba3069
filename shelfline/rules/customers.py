"""Customer dimension."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline import params
from shelfline.functions.dates import date_to_sk
from shelfline.functions.text import record_checksum, sha256_hex
from shelfline.operators.filters import pick
from shelfline.rules.promotions import words

# Words of the customer dimension.
SPORTS = ("Running", "Basketball", "Training", "Soccer", "Golf", "Lifestyle")
ACQUISITION = ("Organic Search", "Paid Search", "Social Media", "Email", "Referral", "Direct", "Affiliate")
TIER_LIMITS = (("Bronze", 50), ("Silver", 80), ("Gold", 95))
TOP_TIER = "Elite"


def spread_100(sk: Column, multiplier: int) -> Column:
    """A number from 0 to 99 that looks unrelated to the key's order."""
    return F.pmod(sk * multiplier, F.lit(100))


def loyalty_tier(is_member: Column, draw: Column) -> Column:
    tier = F.lit(TOP_TIER)
    for name, limit in reversed(TIER_LIMITS):
        tier = F.when(draw < limit, name).otherwise(tier)
    return F.when(is_member, tier)


def ltv_band(tier: Column, draw: Column) -> Column:
    """Value band from a draw of 0 to 99; better tiers reach higher bands more often."""

    def band(limits: tuple[int, int, int]) -> Column:
        low, mid, high, vip = params.LTV_BANDS
        return (
            F.when(draw < limits[0], low).when(draw < limits[1], mid).when(draw < limits[2], high).otherwise(vip)
        )

    result = band(params.LTV_DEFAULT_LIMITS)
    for name, limits in params.LTV_BAND_LIMITS.items():
        result = F.when(tier == name, band(limits)).otherwise(result)
    return result


def build_dim_customer(raw: DataFrame, epoch: date | Column, columns: Sequence[str] = ()) -> DataFrame:
    """From (customer_sk, customer_segment, country_code, state_code, city) to customers."""
    sk = F.col("customer_sk")
    member = F.pmod(sk, F.lit(20)) < 13
    tier = loyalty_tier(member, spread_100(sk, 7919))
    gender = F.when(F.pmod(sk, F.lit(25)) < 12, "M").when(F.pmod(sk, F.lit(25)) < 24, "F").otherwise(
        pick(words(("N", "U")), sk)
    )
    born = F.date_add(F.lit(date(1960, 1, 1)), F.pmod(sk * 37, F.lit(16400)).cast("int"))
    enrolled = F.date_sub(F.lit(epoch), (F.pmod(sk, F.lit(1470)) + 30).cast("int"))
    number = sk.cast("string")
    attributes = {
        "customer_sk": lambda: sk,
        "customer_nk": lambda: F.concat(F.lit("CRM-"), F.upper(F.substring(F.md5(number), 1, 8))),
        "first_name": lambda: F.concat(F.lit("FirstName"), number),
        "last_name": lambda: F.concat(F.lit("LastName"), number),
        "email_address_hash": lambda: sha256_hex(F.concat(F.lit("customer"), number, F.lit("@email.com"))),
        "phone_hash": lambda: sha256_hex(F.concat(F.lit("+1"), F.lpad(number, 10, "5"))),
        "date_of_birth_sk": lambda: date_to_sk(born),
        "gender_code": lambda: gender,
        "loyalty_member_flag": lambda: member,
        "loyalty_tier": lambda: tier,
        "loyalty_points_balance": lambda: F.when(member, F.pmod(sk * 97, F.lit(50000))).otherwise(0).cast("int"),
        "loyalty_enroll_date_sk": lambda: F.when(member, date_to_sk(enrolled)),
        "customer_segment": lambda: F.col("customer_segment"),
        "preferred_sport": lambda: pick(words(SPORTS), sk),
        "lifetime_value_band": lambda: ltv_band(tier, spread_100(sk, 104729)),
        "acquisition_channel": lambda: pick(words(ACQUISITION), sk),
        "city": lambda: F.col("city"),
        "state_province": lambda: F.col("state_code"),
        "country_code": lambda: F.col("country_code"),
        "postal_code": lambda: (F.pmod(sk, F.lit(90000)) + 10000).cast("string"),
        "effective_date": lambda: F.date_sub(F.lit(epoch), F.pmod(sk, F.lit(730)).cast("int")),
        "expiry_date": lambda: F.lit(params.FAR_FUTURE),
        "is_current_flag": lambda: F.lit(True),
    }
    tracked = ("loyalty_tier", "customer_segment", "lifetime_value_band", "city", "state_province", "country_code")
    attributes["record_checksum"] = lambda: record_checksum(*[attributes[c]() for c in tracked])
    return raw.select(*[attributes[c]().alias(c) for c in columns or attributes])


def with_guest(customers: DataFrame, since: date | Column) -> DataFrame:
    """Add the row that sales without a customer point to."""
    known = {
        "customer_sk": F.lit(params.GUEST_CUSTOMER_SK).cast("bigint"),
        "customer_nk": F.lit(params.GUEST_CUSTOMER_NK),
        "first_name": F.lit("Guest"),
        "last_name": F.lit("Customer"),
        "email_address_hash": sha256_hex(F.lit("guest@unknown.com")),
        "phone_hash": sha256_hex(F.lit("unknown")),
        "gender_code": F.lit("U"),
        "loyalty_member_flag": F.lit(False),
        "loyalty_points_balance": F.lit(0),
        "customer_segment": F.lit("Guest"),
        "lifetime_value_band": F.lit("Unknown"),
        "acquisition_channel": F.lit("Unknown"),
        "effective_date": F.lit(since),
        "expiry_date": F.lit(params.FAR_FUTURE),
        "is_current_flag": F.lit(True),
        "record_checksum": sha256_hex(F.lit("guest_customer_0")),
    }
    guest = customers.sparkSession.range(1).select(
        *[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in customers.schema.fields]
    )
    return customers.unionByName(guest)
