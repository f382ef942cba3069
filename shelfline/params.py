"""Business parameters. Functions take them as arguments and default to these."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

# The business rules are defined by these numbers and words.
FAR_FUTURE = date(9999, 12, 31)

REVENUE_TIERS = ((Decimal("500"), "High-Value"), (Decimal("100"), "Mid-Value"))
LOWEST_TIER = "Low-Value"

USD_RATES = {
    "EUR": Decimal("1.08"),
    "GBP": Decimal("1.27"),
    "CNY": Decimal("0.14"),
    "JPY": Decimal("0.0067"),
    "USD": Decimal("1"),
}

RETURN_REASONS = {
    "SIZE": "Wrong Size",
    "FIT": "Poor Fit",
    "DEFECT": "Product Defect",
    "COLOR": "Color Mismatch",
    "QUALITY": "Quality Issues",
    "CHANGED_MIND": "Changed Mind",
    "DAMAGED": "Received Damaged",
    "LATE_DELIVERY": "Late Delivery",
}
RETURN_CONDITIONS = ("SALEABLE", "DAMAGED", "DEFECTIVE")
RESTOCKING_FEE_RATE = Decimal("0.15")
RETURN_WINDOW_DAYS = 30

DIGITAL_CHANNELS = (2, 3, 4)
WHOLESALE_CHANNELS = (6, 7, 8)
OWN_STORE_CHANNELS = (1, 5)

FISCAL_YEAR_FIRST_MONTH = 6

FIXED_HOLIDAYS = {
    (1, 1): "New Year Day",
    (7, 4): "Independence Day",
    (12, 25): "Christmas Day",
    (12, 26): "Boxing Day",
}

SEASON_MONTHS = {
    "SPRING": (3, 4, 5),
    "SUMMER": (6, 7, 8),
    "FALL": (9, 10, 11),
}
DEFAULT_SEASON = "HOLIDAY"

FOURTH_QUARTER_UPLIFT = 1.5
SALE_DAY_UPLIFT = 3.0
WEEKEND_UPLIFT = 1.2
BACK_TO_SCHOOL_UPLIFT = 1.3

AVERAGE_DAILY_UNITS = 2.5
REORDER_POINT = 20

CAMPAIGN_TRAFFIC = ("PAID", "EMAIL", "SOCIAL")

HERO_PRICE_UPLIFT = Decimal("1.3")

LTV_BANDS = ("Low", "Mid", "High", "VIP")
# Upper ends, in percent, of the Low, Mid and High bands for each loyalty tier.
LTV_BAND_LIMITS = {
    "Elite": (0, 10, 40),
    "Gold": (5, 30, 80),
    "Silver": (15, 60, 90),
}
LTV_DEFAULT_LIMITS = (40, 80, 95)

NORTH_AMERICA = ("US", "CA", "MX")
TOP_COUNTRIES = ("US", "CN", "GB", "DE", "JP")
TOP_CITY_COUNTRIES = ("US", "CN")

GUEST_CUSTOMER_SK = 0
GUEST_CUSTOMER_NK = "GUEST-ANONYMOUS"
