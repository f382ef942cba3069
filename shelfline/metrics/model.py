"""What a metric layer declares."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame


@dataclass(frozen=True)
class Format:
    """How a value is shown. No ``places`` are all of them. ``fraction`` marks ratios that are not yet percent; ``grouped``
    separates thousands; dates are shown in ``date_order``, their parts filled up with ``leading_zeros``."""

    type: str = "number"
    currency_code: str | None = None
    places: int | None = None
    compact: bool = False
    fraction: bool = False
    grouped: bool = True
    date_order: str = "year_month_day"
    leading_zeros: bool = True

    @property
    def declared(self) -> str:
        """The format in words: type, currency, places and whether it is compact."""
        places = () if self.type == "date" else ("all" if self.places is None else str(self.places),)
        return " ".join(filter(None, (self.type, self.currency_code, *places, "compact" if self.compact else None)))


@dataclass(frozen=True)
class Described:
    name: str
    label: str
    comment: str = ""
    synonyms: tuple[str, ...] = ()
    format: Format | None = None


@dataclass(frozen=True)
class Dimension(Described):
    """An attribute to group or filter by: a column of the fact or of an entity."""

    column: str = ""
    entity: str | None = None


@dataclass(frozen=True)
class TimeDimension(Described):
    """A period of the fact's date."""

    grain: str = "day"


@dataclass(frozen=True)
class Measure:
    """An aggregate of one fact column: ``money`` and ``units`` are sums,
    ``distinct`` counts different non-NULL values."""

    kind: str
    column: str


class Predicate:
    """A condition on attributes; conditions combine by &, | and ~."""

    def __and__(self, other: Predicate) -> Predicate:
        return All((self, other))

    def __or__(self, other: Predicate) -> Predicate:
        return Any((self, other))

    def __invert__(self) -> Predicate:
        return Not(self)


@dataclass(frozen=True)
class Condition(Predicate):
    """A test of one dimension. ``op``: = != < <= > >=, in, between, like, is null, or one of the last four with a not."""

    dimension: str
    op: str
    value: object = None


@dataclass(frozen=True)
class All(Predicate):
    parts: tuple[Predicate, ...]


@dataclass(frozen=True)
class Any(Predicate):
    parts: tuple[Predicate, ...]


@dataclass(frozen=True)
class Not(Predicate):
    part: Predicate


@dataclass(frozen=True)
class Simple(Described):
    """A measure, optionally over the rows that meet a predicate on dimensions or fact columns."""

    measure: Measure = field(default=Measure("money", ""))
    where: Predicate | None = None


@dataclass(frozen=True)
class Windowed(Described):
    """A measure over a calendar range that ends at each day.

    ``span``: trailing, current, cumulative or to_date."""

    measure: Measure = field(default=Measure("money", ""))
    span: str = "cumulative"
    days: int = 0
    include_today: bool = False
    grain: str = "year"


@dataclass(frozen=True)
class Input:
    """A metric used in a formula, possibly as it was some days earlier."""

    metric: str
    days_ago: int = 0


@dataclass(frozen=True)
class Derived(Described):
    """A formula over other metrics, applied after aggregation."""

    inputs: tuple[Input, ...] = ()
    formula: Callable[..., Column] = lambda *c: c[0]


Metric = Simple | Windowed | Derived


@dataclass(frozen=True)
class Entity:
    """A dimension table reached through a key of the fact. ``hot_keys`` are keys that a large part of the facts has."""

    name: str
    fact_key: str
    dim_key: str
    hot_keys: tuple[object, ...] = ()


@dataclass(frozen=True)
class Layer:
    name: str
    date_column: str
    dimensions: dict[str, Dimension | TimeDimension]
    metrics: dict[str, Metric]
    entities: dict[str, Entity]
    spine: bool = False


@dataclass(frozen=True)
class Sources:
    """Where a layer's data comes from. Each callable gets the wanted columns,
    so that nothing else is read or joined.

    A fact that is itself built from a dimension's table can bring that
    dimension's attributes along, which saves a second join. ``carried`` names
    such entities; ``fact`` then gets their attributes by entity as a second
    argument and returns them as _entity_column.

    ``spine`` is a stored time spine, a table of days. Windowed and shifted
    metrics of a layer with a spine are shown for its days, from the first to
    the last day of the facts; without a table these are all days.

    ``counted_by`` names, for columns whose values are counted, another one of
    the fact that has as many values for any rows. Where the fact's rows lie
    together by that column, they are counted without another shuffle."""

    fact: Callable[..., DataFrame]
    entities: dict[str, Callable[[list[str]], DataFrame]]
    carried: frozenset[str] = frozenset()
    spine: Callable[[], DataFrame] | None = None
    spine_day: str = "date_day"
    counted_by: Mapping[str, str] = field(default_factory=dict)


def layer_of(name: str, date_column: str, dimensions, metrics, entities, spine: bool = False) -> Layer:
    return Layer(
        name,
        date_column,
        {d.name: d for d in dimensions},
        {m.name: m for m in metrics},
        {e.name: e for e in entities},
        spine,
    )
