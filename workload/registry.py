"""Named queries: a function of the star and, where SQL can say it, a SQL text."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from workload.oracle import sql
from workload.star import Star


@dataclass(frozen=True)
class Entry:
    name: str
    run: Callable[[Star], DataFrame]
    oracle: str | None


ENTRIES: dict[str, Entry] = {}


def add(name: str, run: Callable[[Star], DataFrame], oracle: str | None = None) -> None:
    if name in ENTRIES:
        raise ValueError(f"{name} is registered twice")
    ENTRIES[name] = Entry(name, run, sql(oracle) if oracle else None)


def query(name: str, oracle: str | None = None):
    """Decorator form of ``add``."""

    def register(run: Callable[[Star], DataFrame]) -> Callable[[Star], DataFrame]:
        add(name, run, oracle)
        return run

    return register
