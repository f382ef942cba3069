"""Calendar windows over daily aggregates.

Every operator here takes a frame with at most one row per group and day. A
group then has no more rows than the calendar has days, however many facts lie
behind it. Frames are calendar ranges: a missing day counts as missing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from shelfline.functions.dates import day_ordinal, period_start


# Values of at most so many days ago are carried along when days are filled.
CARRIED_DAYS = 31


def _by_day(keys: Sequence[Column | str], day: str) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(day_ordinal(F.col(day)))


def trailing(column: str, keys: Sequence[str], day: str, days: int, include_today: bool = False) -> Column:
    """Sum over the last ``days`` days; NULL when no row falls in them."""
    first, last = (1 - days, 0) if include_today else (-days, -1)
    return F.sum(column).over(_by_day(keys, day).rangeBetween(first, last))


def value_days_ago(column: str, keys: Sequence[str], day: str, days: int) -> Column:
    return F.sum(column).over(_by_day(keys, day).rangeBetween(-days, -days))


def running_total(column: str, keys: Sequence[str], day: str) -> Column:
    return F.sum(column).over(_by_day(keys, day).rangeBetween(Window.unboundedPreceding, 0))


def period_to_date(column: str, keys: Sequence[str], day: str, grain: str = "year") -> Column:
    """Running total that starts again with each year, quarter or month."""
    in_period = _by_day([*keys, period_start(F.col(day), grain)], day)
    return F.sum(column).over(in_period.rangeBetween(Window.unboundedPreceding, 0))


def last_in_group(df: DataFrame, keys: Sequence[str], day: str, values: Sequence[str]) -> DataFrame:
    """Semi-additive totals: each value as it stands on the group's last day."""
    return df.groupBy(*keys).agg(*[F.max_by(v, day).alias(v) for v in values])


def spine_days(daily: DataFrame, day: str, keys: Sequence[str] = ()) -> DataFrame:
    """Every calendar day between the first and last day of all rows, for each group."""
    dated = daily.where(F.col(day).isNotNull())
    ends = dated.select(*keys).distinct().withColumn("_ends", _ends(dated, day).scalar()) if keys else _ends(dated, day)
    days = F.explode(F.sequence("_ends.first", "_ends.last", F.expr("interval 1 day"))).alias(day)
    return ends.select(*keys, days)


def _ends(daily: DataFrame, day: str) -> DataFrame:
    """The first and last day of all rows, in one row."""
    return daily.agg(F.struct(F.min(day).alias("first"), F.max(day).alias("last")).alias("_ends"))


def fill_days(
    daily: DataFrame, day: str, keys: Sequence[str] = (), ago: Mapping[str, tuple[str, int]] | None = None
) -> DataFrame:
    """The same rows as a left join of ``spine_days`` with ``daily``: each row also
    yields the empty days up to the next row of its group, the first one those
    before it and the last one those after it.

    ``ago`` names further columns, each the ``value_days_ago`` of a column and a
    number of days from 1 to CARRIED_DAYS. A row carries the values of the days
    before it that its filled days look back to, so that filled days, of which
    there may be many more than rows, are neither shuffled nor sorted."""
    ago = dict(ago or {})
    if not all(1 <= days <= CARRIED_DAYS for _, days in ago.values()):
        raise ValueError(f"values of 1 to {CARRIED_DAYS} days ago are carried, not {ago}")
    values = [c for c in daily.columns if c != day and c not in keys]
    dated = daily.where(F.col(day).isNotNull())
    order = _by_day(keys, day)
    near = {"_before": F.lag(day).over(order), "_after": F.lead(day).over(order)}
    if ago:  # the row's own day and those before it, with their values
        reach = order.rangeBetween(-max(days for _, days in ago.values()), 0)
        near["_days"] = F.collect_list(day).over(reach)
        near["_values"] = F.collect_list(F.struct(*sorted({v for v, _ in ago.values()}))).over(reach)
    spread = dated.withColumns(near)
    first = last = F.col(day)
    if keys:  # after the shuffle of the windows
        spread = spread.withColumn("_ends", _ends(dated, day).scalar())
        first, last = F.col("_ends.first"), F.col("_ends.last")
    since = F.when(F.col("_before").isNull(), first).otherwise(F.col(day))
    until = F.coalesce(F.date_sub("_after", 1), last)
    if ago:
        spread = spread.withColumn("_carried", F.map_from_arrays("_days", "_values"))
    spread = spread.select("*", F.explode(F.sequence(since, until, F.expr("interval 1 day"))).alias("_filled"))
    own = [F.when(F.col("_filled") == F.col(day), F.col(v)).alias(v) for v in values]
    summed = daily.select(*[F.sum(v).alias(n) for n, (v, _) in ago.items()]).schema if ago else {}
    earlier = [
        F.try_element_at("_carried", F.date_sub("_filled", days))[v].cast(summed[n].dataType).alias(n) for n, (v, days) in ago.items()
    ]
    return spread.select(*keys, F.col("_filled").alias(day), *own, *earlier)


def membership_changes(
    df: DataFrame, keys: Sequence[str], day: str, member: str, days: int, include_today: bool, alias: str
) -> DataFrame:
    """Days on which the set of members seen in the trailing window grows or shrinks.

    Each (group, member, day) opens a stretch of ``days`` days that ends early
    when the member's next one opens, so stretches of one member never overlap.
    Summing the +1 and -1 up to a day gives the distinct count of that day,
    with two rows per active day whatever the window length.
    """
    seen = df.where(F.col(member).isNotNull()).select(*keys, day, member).distinct()
    next_day = F.lead(day).over(Window.partitionBy(*keys, member).orderBy(day))
    opens = F.date_add(F.col(day), 0 if include_today else 1)
    closes = F.least(F.date_add(opens, days), F.date_add(F.col("_next"), 0 if include_today else 1))
    moves = F.array(
        F.struct(opens.alias("day"), F.lit(1).alias("change")),
        F.struct(closes.alias("day"), F.lit(-1).alias("change")),
    )
    return (
        seen.withColumn("_next", next_day)
        .select(*keys, F.explode(moves).alias("_move"))
        .select(*keys, F.col("_move.day").alias(day), F.col("_move.change").alias(alias))
        .groupBy(*keys, day)
        .agg(F.sum(alias).cast("bigint").alias(alias))
    )


def with_trailing_distinct(
    days: DataFrame, facts: DataFrame, keys: Sequence[str], day: str, member: str,
    length: int, alias: str, include_today: bool = False,
) -> DataFrame:
    """Add to ``days`` (one row per group and day) the number of distinct members
    among the facts of the trailing window; 0 when there are none."""
    changes = membership_changes(facts, keys, day, member, length, include_today, alias)
    stacked = days.withColumn("_wanted", F.lit(1)).unionByName(
        changes.withColumn("_wanted", F.lit(0)), allowMissingColumns=True
    )
    values = [c for c in days.columns if c != day and c not in keys]
    merged = stacked.groupBy(*keys, day).agg(
        *[F.max(v).alias(v) for v in values], F.max("_wanted").alias("_wanted"), F.sum(alias).alias(alias)
    )
    total = F.coalesce(running_total(alias, keys, day), F.lit(0)).cast("bigint")
    return merged.withColumn(alias, total).where("_wanted = 1").drop("_wanted")
