"""Metric queries: metrics, group keys, conditions and order in; a frame out.

A request reads the fact once for its sums and each kind of distinct count it has. A request with windows or shifted values
makes all its sums from one row per group and day, which is stored where it is read several times. Its distinct counts read
the fact, too, if one read more does; otherwise the fact is first brought to one row per group, day and counted member, which
is stored, so that it is read once altogether.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, timedelta
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.dates import period_start
from shelfline.functions.ratios import money_sum, unit_sum
from shelfline.metrics.model import (
    All,
    Derived,
    Dimension,
    Input,
    Layer,
    Measure,
    Metric,
    Predicate,
    Simple,
    Sources,
    TimeDimension,
    Windowed,
)
from shelfline.metrics.predicates import Clause, can_hold_without, clauses, conjuncts, implied, resolved, to_column
from shelfline.operators import windows
from shelfline.operators.joins import many_to_one, merge_results, only_known
from shelfline.sources.scratch import stored

DAY = "_day"


def aggregate(measure: Measure, where: Column | None = None) -> Column:
    """The aggregate column of a measure. The condition sits inside it, so other
    metrics of the same query keep all rows."""
    value = F.col(measure.column)
    if where is not None:
        value = F.when(where, value)
    if measure.kind == "distinct":
        return F.count_distinct(value)
    return _sum(measure.kind, value)


def _sum(kind: str, value: Column) -> Column:
    return money_sum(value) if kind == "money" else unit_sum(value)


def _as_mapping(names: Sequence[str] | Mapping[str, str]) -> dict[str, str]:
    return dict(names) if isinstance(names, Mapping) else {n: n for n in names}


def resolve_name(name: str, entries: Mapping[str, object]) -> str:
    """A declared name, or the one that has ``name`` as label or synonym."""
    if name in entries:
        return name
    term = name.strip().lower()
    for key, entry in entries.items():
        if term == entry.label.lower() or term in entry.synonyms:
            return key
    raise KeyError(f"unknown name: {name}")


def _fact_or_declared(layer: Layer, name: str) -> Dimension | TimeDimension:
    """A declared dimension; else, in a metric's own condition, a column of the fact."""
    try:
        return layer.dimensions[resolve_name(name, layer.dimensions)]
    except KeyError:
        return Dimension(name, name, column=name)


@dataclass
class _Query:
    """A resolved request."""

    layer: Layer
    sources: Sources
    outputs: dict[str, str]
    keys: dict[str, Dimension | TimeDimension]
    conditions: list[Predicate]
    date_filter: str
    simple: dict[str, Simple] = field(default_factory=dict)
    windowed: dict[str, Windowed] = field(default_factory=dict)
    shifted: set[Input] = field(default_factory=set)

    @property
    def attributes(self) -> dict[str, Dimension]:
        return {a: d for a, d in self.keys.items() if isinstance(d, Dimension)}

    @property
    def periods(self) -> dict[str, TimeDimension]:
        return {a: d for a, d in self.keys.items() if isinstance(d, TimeDimension)}

    @property
    def by_day(self) -> bool:
        return any(p.grain == "day" for p in self.periods.values())

    @property
    def runs_over_days(self) -> bool:
        return bool(self.windowed or self.shifted)

    @cached_property
    def dated(self) -> list[Predicate]:
        """Conditions on nothing but the date."""
        return [p for p in self.conditions if all(isinstance(c.dimension, TimeDimension) for c in clauses(p))]

    @cached_property
    def attributed(self) -> list[Predicate]:
        """Conditions with an attribute in them, which are met by fact rows."""
        return [p for p in self.conditions if p not in self.dated]

    @cached_property
    def metrics(self) -> list[Simple | Windowed]:
        """All that is aggregated from the fact."""
        shifted = [self.layer.metrics[i.metric] for i in sorted(self.shifted, key=str)]
        return list({m.name: m for m in (*self.simple.values(), *self.windowed.values(), *shifted)}.values())

    def condition_of(self, metric: Metric) -> Predicate | None:
        """A metric's own condition."""
        where = getattr(metric, "where", None)
        return where and resolved(where, lambda name: _fact_or_declared(self.layer, name))

    def collect(self, name: str, days_ago: int = 0) -> None:
        metric = self.layer.metrics[name]
        if isinstance(metric, Derived):
            for item in metric.inputs:
                self.collect(item.metric, days_ago + item.days_ago)
            return
        if days_ago:
            self.shifted.add(Input(name, days_ago))
        if isinstance(metric, Windowed):
            self.windowed[name] = metric
        elif not days_ago:
            self.simple[name] = metric


def _shifted_name(item: Input) -> str:
    return f"{item.metric}__{item.days_ago}_days_ago"


# --- fact rows --------------------------------------------------------------------------------------


def _rows(query: _Query, metrics: Sequence[Simple | Windowed]) -> DataFrame:
    """Fact rows that meet the conditions on attributes, with the day, the group keys, and for each metric its amount, or the
    member it counts and whether its own condition holds; and nothing else."""
    layer, sources = query.layer, query.sources
    own = {m.name: query.condition_of(m) for m in metrics}
    shown = [*query.attributes.values(), *[c.dimension for p in own.values() if p for c in clauses(p)]]
    semi, tested = _semi_joined(query, shown)
    asked = [c.dimension for p in query.attributed for c in clauses(p)]

    columns = {layer.date_column} | {_read_column(sources, m) for m in metrics}
    columns |= {d.column for d in (*shown, *asked) if isinstance(d, Dimension) and d.entity is None}
    joined: dict[str, set[str]] = {}
    for d in (*shown, *[c.dimension for p in tested for c in clauses(p)]):
        if isinstance(d, Dimension) and d.entity:
            joined.setdefault(d.entity, set()).add(d.column)
    carried = {e: sorted(a) for e, a in joined.items() if e in sources.carried}
    apart = {e: a for e, a in joined.items() if e not in carried}
    columns |= {layer.entities[e].fact_key for e in (*apart, *semi)}

    extra = [carried] if carried else []
    fact = sources.fact(sorted(columns), *extra).withColumn(DAY, F.col(layer.date_column))
    fact = _where(fact, [p for p in map(_of_fact, query.attributed) if p])
    for name, parts in semi.items():
        entity = layer.entities[name]
        read = sources.entities[name](sorted({entity.dim_key, *[c.dimension.column for p in parts for c in clauses(p)]}))
        known = read.where(to_column(All(tuple(parts)), lambda d: F.col(d.column))).select(entity.dim_key)
        fact = only_known(fact, known, entity.fact_key, entity.dim_key)
    wide = _where(with_entities(layer, sources, fact, apart), tested)
    values = {a: _dimension_column(d) for a, d in query.attributes.items()}
    for m in metrics:
        met = to_column(own[m.name], _dimension_column) if own[m.name] else None
        value = F.col(_read_column(sources, m))
        if m.measure.kind == "distinct":
            values[_member(m)] = value
            if met is not None:
                values[f"_met_{m.name}"] = F.coalesce(met, F.lit(False))
        else:
            values[_amount(m)] = value if met is None else F.when(met, value)
    return wide.select(F.col(DAY), *[c.alias(n) for n, c in values.items()])


def _member(metric: Simple | Windowed) -> str:
    return f"_member_{metric.measure.column}"


def _amount(metric: Simple | Windowed) -> str:
    """The column that a metric sums: one for all metrics that sum the same column without a condition."""
    return f"_sum_{metric.name}" if getattr(metric, "where", None) else f"_amount_{metric.measure.kind}_{metric.measure.column}"


def _read_column(sources: Sources, metric: Simple | Windowed) -> str:
    """The column of the fact that a metric is made from."""
    column = metric.measure.column
    return sources.counted_by.get(column, column) if metric.measure.kind == "distinct" else column


def _of_fact(p: Predicate) -> Predicate | None:
    """What a condition asks of the fact's own columns."""
    return implied(p, lambda c: c.entity is None)


def _semi_joined(query: _Query, kept: Iterable[Dimension | TimeDimension]) -> tuple[dict[str, list[Predicate]], list[Predicate]]:
    """Conditions by the entity whose rows can be chosen first, so that facts only look for a key; and those that need the
    entity's attributes next to the fact's, in whole. Of an or across tables, what it asks of one table is among the first."""
    shown = {d.entity for d in kept if isinstance(d, Dimension)} | query.sources.carried
    semi: dict[str, list[Predicate]] = {}
    tested = []
    for p in query.attributed:
        read = {c.entity for c in clauses(p)}
        entities = sorted(e for e in read if e and e not in shown)
        for e in entities:
            part = implied(p, lambda c, e=e: c.entity == e)
            if part and not can_hold_without(part, e):
                semi.setdefault(e, []).append(part)
        whole = len(read) == 1 and (read == {None} or (entities and entities[0] in semi and p in semi[entities[0]]))
        if not whole:
            tested.append(p)
    return semi, tested


def with_entities(
    layer: Layer, sources: Sources, fact: DataFrame, attributes: Mapping[str, Iterable[str]]
) -> DataFrame:
    """Add dimension attributes by entity name, as _entity_column. Only the
    entities named are joined, each with its key and those attributes."""
    out = fact
    for name in sorted(attributes):
        entity, wanted = layer.entities[name], sorted(attributes[name])
        frame = sources.entities[name]([entity.dim_key, *wanted])
        renamed = frame.select(entity.dim_key, *[F.col(c).alias(f"_{name}_{c}") for c in wanted])
        out = many_to_one(out, renamed, entity.fact_key, entity.dim_key, hot_keys=entity.hot_keys)
    return out


def _dimension_column(dim: Dimension | TimeDimension) -> Column:
    if isinstance(dim, TimeDimension):
        return period_start(F.col(DAY), dim.grain)
    return F.col(f"_{dim.entity}_{dim.column}" if dim.entity else dim.column)


def _where(df: DataFrame, predicates: Sequence[Predicate]) -> DataFrame:
    return reduce(lambda rest, p: rest.where(to_column(p, _dimension_column)), predicates, df)


# --- history ----------------------------------------------------------------------------------------


def _history_start(query: _Query) -> date | None:
    """The earliest day that can matter for a query from some day on; None if all do."""
    bounds = [
        _as_day(c.value[0] if c.op == "between" else c.value) for c in query.dated
        if isinstance(c, Clause) and c.dimension.grain == "day" and c.op in (">=", ">", "=", "between")
    ]
    bounds = [b for b in bounds if b is not None]
    if not bounds or query.layer.spine:
        return None
    first = max(bounds)
    starts = [first - timedelta(days=i.days_ago) for i in query.shifted]
    for name, metric in query.windowed.items():
        if metric.span == "cumulative" or (metric.span == "to_date" and metric.grain != "year"):
            return None
        ago = max((i.days_ago for i in query.shifted if i.metric == name), default=0)
        reached = first - timedelta(days=ago)
        starts.append(date(reached.year, 1, 1) if metric.span == "to_date" else reached - timedelta(days=metric.days))
    return min([first, *starts])


def _as_day(value: object) -> date | None:
    """A date, also from text like 2024-06-01; None for all else."""
    if isinstance(value, str):
        try:
            return date.fromisoformat(value)
        except ValueError:
            return None
    return value if isinstance(value, date) else None


def _history(query: _Query) -> DataFrame:
    """The fact rows that a request over days can need."""
    rows = _rows(query, query.metrics)
    if query.date_filter == "before":
        return _where(rows, query.dated)
    start = _history_start(query)
    return rows if start is None else rows.where(F.col(DAY) >= F.lit(start))


def _reads(query: _Query) -> int:
    """How often a request over days reads the fact if each of its distinct counts does so by itself. Sums take one read, and
    the counts per day of one kind of member go along with it."""
    plain = {_member(m) for m in query.simple.values() if m.measure.kind == "distinct"}
    windowed = [m for m in query.windowed.values() if m.measure.kind == "distinct"]
    shifted = [i for i in query.shifted if query.layer.metrics[i.metric].measure.kind == "distinct" and i.metric not in query.windowed]
    return 1 + max(len(plain) - query.by_day, 0) + len(windowed) + len(shifted)


def _members_by_day(query: _Query, rows: DataFrame) -> DataFrame:
    """A row per group, day and combination of counted members, with sums, and whether the members meet the metrics'
    conditions: the one table that a request with several kinds of counts is answered from."""
    members = sorted({_member(m) for m in query.metrics if m.measure.kind == "distinct"})
    aggs = _partial_sums(m for m in query.metrics if m.measure.kind != "distinct")
    for m in query.metrics:
        if f"_met_{m.name}" in rows.columns:
            aggs.append(F.max(f"_met_{m.name}").alias(f"_met_{m.name}"))
    keys = [*query.attributes, DAY, *members]
    return stored(rows.groupBy(*keys).agg(*aggs) if aggs else rows.select(*keys).distinct(), "members_by_day")


def _daily(query: _Query, rows: DataFrame) -> DataFrame:
    """A row per group and day with all sums that the request needs, and for requests by day its plain metrics."""
    summed = {f"_day_{n}": m for n, m in query.windowed.items() if m.measure.kind != "distinct"}
    shifted = {f"_now_{_shifted_name(i)}": query.layer.metrics[i.metric] for i in query.shifted if i.metric not in query.windowed}
    plain = query.simple if query.by_day else {_amount(m): m for m in _sums(query.simple).values()}
    return _totals(rows, [*query.attributes, DAY], {**summed, **shifted, **plain})


# --- aggregates -------------------------------------------------------------------------------------


def _totals(rows: DataFrame, keys: Sequence[str], metrics: Mapping[str, Simple | Windowed]) -> DataFrame:
    """Sums and distinct counts by the keys. Rows are first brought to one per key and member, which makes each member count
    once; sums go along with the first kind of member. No row is multiplied by the number of counts."""
    sums = {n: m for n, m in metrics.items() if m.measure.kind != "distinct"}
    members = sorted({_member(m) for m in metrics.values() if m.measure.kind == "distinct"})
    if not members:
        return rows.groupBy(*keys).agg(*_summed(sums)) if sums else rows.select(*keys).distinct()
    parts = []
    for member in members:
        counted = {n: m for n, m in metrics.items() if m.measure.kind == "distinct" and _member(m) == member}
        flags = [f"_met_{m.name}" for m in counted.values() if f"_met_{m.name}" in rows.columns]
        along = sums if member == members[0] else {}
        partial = _partial_sums(along.values()) + [F.max(f).alias(f) for f in flags]
        once = rows.groupBy(*keys, member).agg(*partial) if partial else rows.select(*keys, member).distinct()
        counts = []
        for n, m in counted.items():
            met = f"_met_{m.name}"
            counts.append(F.count(F.when(F.col(met), F.col(member)) if met in flags else F.col(member)).alias(n))
        parts.append(once.groupBy(*keys).agg(*_summed(along), *counts))
    return merge_results(parts, keys)


def _partial_sums(metrics: Iterable[Simple | Windowed]) -> list[Column]:
    return [F.sum(a).alias(a) for a in dict.fromkeys(_amount(m) for m in metrics)]


def _summed(metrics: Mapping[str, Simple | Windowed]) -> list[Column]:
    return [_sum(m.measure.kind, F.col(_amount(m))).alias(n) for n, m in metrics.items()]


def _window_column(metric: Windowed, keys: Sequence[str]) -> Column:
    value = f"_day_{metric.name}"
    if metric.span == "current":
        return F.col(value)
    if metric.span == "trailing":
        return windows.trailing(value, keys, DAY, metric.days, metric.include_today)
    if metric.span == "to_date":
        return windows.period_to_date(value, keys, DAY, metric.grain)
    return windows.running_total(value, keys, DAY)


def _carried(query: _Query) -> dict[str, tuple[str, int]]:
    """Shifted values, by name with their day's value, that the filling of days can bring along. Where another window runs
    over the filled days anyway, one more needs no help."""
    if not query.layer.spine or query.windowed or any(i.days_ago > windows.CARRIED_DAYS for i in query.shifted):
        return {}
    return {n: (f"_now_{n}", i.days_ago) for i in query.shifted for n in (_shifted_name(i),)}


def _over_days(query: _Query, rows: DataFrame, daily: DataFrame) -> DataFrame:
    """One row per group and day with all windowed, shifted and, for queries by
    day, simple metrics."""
    keys = list(query.attributes)
    counted = {n: m for n, m in query.windowed.items() if m.measure.kind == "distinct"}
    plain = query.simple if query.by_day else {}
    carried = _carried(query)
    if query.layer.spine:
        daily = windows.fill_days(daily, DAY, keys, carried)
    for name, metric in counted.items():
        if metric.span != "trailing":
            raise ValueError(f"{name}: distinct counts are only windowed over trailing days")
        daily = windows.with_trailing_distinct(daily, rows, keys, DAY, _member(metric), metric.days, name, metric.include_today)
    computed = {n: _window_column(m, keys) for n, m in query.windowed.items() if n not in counted}
    later = {}
    for item in query.shifted:
        name = _shifted_name(item)
        if name in carried:
            computed[name] = F.col(name)
        elif item.metric in query.windowed:
            later[name] = windows.value_days_ago(item.metric, keys, DAY, item.days_ago)
        else:
            computed[name] = windows.value_days_ago(f"_now_{name}", keys, DAY, item.days_ago)
    days = daily.select(*keys, DAY, *counted, *plain, *[c.alias(n) for n, c in computed.items()])
    days = days.withColumns(later) if later else days
    sources = query.sources
    if query.layer.spine and sources.spine:  # after the windows, which run over all days
        days = only_known(days, sources.spine(), DAY, sources.spine_day)
    return days


def _period_columns(query: _Query) -> dict[str, Column]:
    return {a: period_start(F.col(DAY), p.grain) for a, p in query.periods.items()}


def _evaluate(layer: Layer, name: str, days_ago: int = 0) -> Column:
    metric = layer.metrics[name]
    if isinstance(metric, Derived):
        return metric.formula(*[_evaluate(layer, i.metric, days_ago + i.days_ago) for i in metric.inputs])
    column = F.col(_shifted_name(Input(name, days_ago)) if days_ago else name)
    if isinstance(metric, Windowed) and metric.measure.kind == "money":
        return column.cast("decimal(24,4)")
    return column


def metric_query(
    layer: Layer,
    sources: Sources,
    metrics: Sequence[str] | Mapping[str, str],
    group_by: Sequence[str] | Mapping[str, str] = (),
    where: Sequence[Predicate] | Predicate = (),
    order_by: Sequence[str] = (),
    date_filter: str = "after",
) -> DataFrame:
    """Metrics by dimensions.

    ``metrics`` and ``group_by`` are names, or output names mapped to names.
    Names may be labels or synonyms. ``where`` is a predicate, or several that
    all have to hold. Those with an attribute in them apply before any window;
    those on the date alone apply after the windows, so the first days shown
    have their full history; ``date_filter="before"`` cuts history too.
    Without a date among the keys, windowed metrics show their last day.
    A request with windows or shifted values may store its daily table at once.
    """
    outputs = {o: resolve_name(n, layer.metrics) for o, n in _as_mapping(metrics).items()}
    keys = {o: layer.dimensions[resolve_name(n, layer.dimensions)] for o, n in _as_mapping(group_by).items()}
    asked = All((where,) if isinstance(where, Predicate) else tuple(where))
    conditions = conjuncts(resolved(asked, lambda name: layer.dimensions[resolve_name(name, layer.dimensions)]))
    query = _Query(layer, sources, outputs, keys, conditions, date_filter)
    for name in outputs.values():
        query.collect(name)

    if query.runs_over_days:
        rows = _history(query)
        if _reads(query) > 2:
            rows = _members_by_day(query, rows)
        daily = _daily(query, rows)
        if not query.by_day or (layer.spine and query.attributes):  # it is read several times
            daily = stored(daily, "daily")
        days = _where(_over_days(query, rows, daily), query.dated).withColumns(_period_columns(query))
        result = days if query.by_day else _last_days(query, days, rows, daily)
    else:
        result = _simple_results(query, query.simple, _rows(query, query.metrics))

    columns = [F.col(k) for k in keys] + [_evaluate(layer, n).alias(o) for o, n in outputs.items()]
    answer = result.select(*columns)
    return answer.orderBy(*order_by) if order_by else answer


def _simple_results(query: _Query, metrics: Mapping[str, Simple], rows: DataFrame) -> DataFrame:
    dated = _where(rows, query.dated).withColumns(_period_columns(query))
    return _totals(dated, list(query.keys), metrics)


def _sums(metrics: Mapping[str, Simple]) -> dict[str, Simple]:
    return {n: m for n, m in metrics.items() if m.measure.kind != "distinct"}


def _last_days(query: _Query, days: DataFrame, rows: DataFrame, daily: DataFrame) -> DataFrame:
    """Windowed metrics at coarser keys: the value of the last day of each group.
    Plain and shifted sums add up over the days; distinct counts are made from
    the members."""
    names = list(query.keys)
    aggs = [F.max_by(n, DAY).alias(n) for n in query.windowed]
    parts = []
    for item in query.shifted:
        name, metric = _shifted_name(item), query.layer.metrics[item.metric]
        if isinstance(metric, Windowed):
            aggs.append(F.max_by(name, DAY).alias(name))
        elif metric.measure.kind == "distinct":
            parts.append(_shifted_count(query, item, metric, rows, daily))
        else:
            aggs.append(F.sum(name).alias(name))
    if aggs:
        parts.append(days.groupBy(*names).agg(*aggs))
    sums = _sums(query.simple)
    counts = {n: m for n, m in query.simple.items() if n not in sums}
    parts += [_simple_results(query, chosen, source) for chosen, source in ((sums, daily), (counts, rows)) if chosen]
    return merge_results(parts, names)


def _shifted_count(query: _Query, item: Input, metric: Simple, rows: DataFrame, daily: DataFrame) -> DataFrame:
    """A distinct count some days earlier at coarser keys: over the members of the
    earlier days, none of which reaches beyond the last day."""
    moved = rows.withColumn(DAY, F.date_add(DAY, item.days_ago)).where(F.col(DAY) <= daily.agg(F.max(DAY)).scalar())
    return _simple_results(query, {_shifted_name(item): metric}, moved)
