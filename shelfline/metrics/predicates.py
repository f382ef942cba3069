"""Predicate trees over attributes, and where in a plan their parts can be tested.

A tree is first brought into a form without Not. Its top-level parts are then told apart by what they read: parts on fact
columns go to the scan, parts on one joined table become a semi-join where missing rows cannot meet them, and the rest waits
for the join. Of that rest, what it implies for the fact or for one table is tested early all the same.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfline.metrics.model import All, Any, Condition, Dimension, Not, Predicate, TimeDimension

OPPOSITE = {
    "=": "!=", "<": ">=", ">": "<=", "in": "not in", "between": "not between", "like": "not like", "is null": "is not null",
}
OPPOSITE |= {b: a for a, b in OPPOSITE.items()}


@dataclass(frozen=True)
class Clause(Predicate):
    """A condition whose dimension is known."""

    dimension: Dimension | TimeDimension
    op: str
    value: object

    @property
    def entity(self) -> str | None:
        return getattr(self.dimension, "entity", None)


def resolved(predicate: Predicate, dimension: Callable[[str], Dimension | TimeDimension]) -> Predicate:
    """The same tree over declared dimensions, with every Not moved into its tests. A test of a NULL is neither true nor
    false, and so is its opposite."""

    def walk(p: Predicate, negated: bool) -> Predicate:
        if isinstance(p, Not):
            return walk(p.part, not negated)
        if isinstance(p, (All, Any)):
            kind = Any if isinstance(p, All) == negated else All
            return kind(tuple(walk(part, negated) for part in p.parts))
        if p.op not in OPPOSITE:
            raise ValueError(f"unknown test: {p.op}")
        return Clause(dimension(p.dimension), OPPOSITE[p.op] if negated else p.op, p.value)

    return walk(predicate, False)


def clauses(p: Predicate) -> Iterator[Clause]:
    if isinstance(p, Clause):
        yield p
    else:
        for part in p.parts:
            yield from clauses(part)


def conjuncts(p: Predicate) -> list[Predicate]:
    """Parts that all have to hold."""
    return [c for part in p.parts for c in conjuncts(part)] if isinstance(p, All) else [p]


def implied(p: Predicate, allowed: Callable[[Clause], bool]) -> Predicate | None:
    """What follows from the tree for the allowed tests alone; None if nothing does."""
    if isinstance(p, Clause):
        return p if allowed(p) else None
    parts = [implied(part, allowed) for part in p.parts]
    if isinstance(p, Any):
        return Any(tuple(parts)) if parts and all(part is not None for part in parts) else None
    held = tuple(part for part in parts if part is not None)
    return All(held) if held else None


def can_hold_without(p: Predicate, entity: str) -> bool:
    """Whether a row that finds no row of the entity, so that its attributes are NULL, may meet the predicate."""
    if isinstance(p, Clause):
        return p.op == "is null" or p.entity != entity
    return (any if isinstance(p, Any) else all)(can_hold_without(part, entity) for part in p.parts)


def test_column(column: Column, op: str, value: object) -> Column:
    plain = {
        "=": lambda: column == value,
        "!=": lambda: column != value,
        "<": lambda: column < value,
        "<=": lambda: column <= value,
        ">": lambda: column > value,
        ">=": lambda: column >= value,
        "in": lambda: column.isin(*value),
        "between": lambda: column.between(*value),
        "like": lambda: column.like(value),
        "is null": column.isNull,
    }
    return plain[op]() if op in plain else ~plain[OPPOSITE[op]]()


def to_column(p: Predicate, column_of: Callable[[Dimension | TimeDimension], Column]) -> Column:
    """The tree as a boolean column. An empty All holds, an empty Any does not."""
    if isinstance(p, Clause):
        return test_column(column_of(p.dimension), p.op, p.value)
    join = Column.__and__ if isinstance(p, All) else Column.__or__
    parts = [to_column(part, column_of) for part in p.parts]
    return reduce(join, parts) if parts else F.lit(isinstance(p, All))
