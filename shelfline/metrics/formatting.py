"""Values as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfline.metrics.model import Format

# Currency signs and the steps of compact numbers.
SIGNS = {"USD": "$", "EUR": "€", "GBP": "£"}
COMPACT_STEPS = ((1_000_000_000, "B"), (1_000_000, "M"), (1_000, "K"))


def _plain(value: Column, places: int | None, grouped: bool = True) -> Column:
    """Digits, rounded half up before they are printed; all places if none are given."""
    whole = "#,##0" if grouped else "0"
    if places is None:
        return F.call_function("format_number", value, F.lit(f"{whole}.##########"))
    pattern = whole + ("." + "0" * places if places else "")
    return F.call_function("format_number", value.cast(f"decimal(38,{places})"), F.lit(pattern))


def _date(value: Column, order: str, leading_zeros: bool) -> Column:
    """A date with its parts in the order named, such as year_month_day."""
    letters = {"year": "yyyy", "month": "MM" if leading_zeros else "M", "day": "dd" if leading_zeros else "d"}
    return F.date_format(value, "-".join(letters[part] for part in order.split("_")))


def compact(value: Column, places: int | None, grouped: bool = True) -> Column:
    """1,234,567 as 1.23M. A value that rounds to a thousand of one step takes the next."""
    size = F.abs(value)
    text, below = _plain(value, places, grouped), 1
    for step, letter in reversed(COMPACT_STEPS):
        reached = size >= step
        if places is not None:
            reached = reached | (F.round((size / below).cast("decimal(38,10)"), places) >= step // below)
        text = F.when(reached, F.concat(_plain(value / step, places, grouped), F.lit(letter))).otherwise(text)
        below = step
    return text


def format_value(value: Column, how: Format | None) -> Column:
    how = how or Format()
    places = how.places
    if how.type == "date":
        return _date(value, how.date_order, how.leading_zeros)
    if how.type == "percentage":
        shown = value * 100 if how.fraction else value
        return F.concat(_plain(shown, places, how.grouped), F.lit("%"))
    number = compact(value, places, how.grouped) if how.compact else _plain(value, places, how.grouped)
    if how.type == "currency":
        return F.concat(F.lit(SIGNS.get(how.currency_code, f"{how.currency_code} ")), number)
    return number
