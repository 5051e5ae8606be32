"""Small builders that turn rule tables into one CASE expression."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_match(rules: Iterable[tuple[Column, object]], default: object) -> Column:
    """Result of the first rule whose condition is true; null conditions do not match."""
    chain = None
    for condition, result in rules:
        chain = F.when(condition, result) if chain is None else chain.when(condition, result)
    return F.lit(default) if chain is None else chain.otherwise(default)


def floors(value: Column, steps: Iterable[tuple[float, object]], default: object) -> Column:
    """Steps are lower bounds, highest first, and include the bound itself."""
    return first_match(((value >= bound, result) for bound, result in steps), default)


def floors_open(value: Column, steps: Iterable[tuple[float, object]], default: object) -> Column:
    """Steps are lower bounds, highest first, and exclude the bound itself."""
    return first_match(((value > bound, result) for bound, result in steps), default)


def ceilings(value: Column, steps: Iterable[tuple[float, object]], default: object) -> Column:
    """Steps are upper bounds, lowest first, and include the bound itself."""
    return first_match(((value <= bound, result) for bound, result in steps), default)


def ceilings_open(value: Column, steps: Iterable[tuple[float, object]], default: object) -> Column:
    """Steps are upper bounds, lowest first, and exclude the bound itself."""
    return first_match(((value < bound, result) for bound, result in steps), default)


def lookup(value: Column, table: Mapping[object, object], default: object = None) -> Column:
    """Constant-map lookup; an absent or null key gives the default."""
    pairs = [F.lit(item) for pair in table.items() for item in pair]
    found = F.try_element_at(F.create_map(*pairs), value)
    return found if default is None else F.coalesce(found, F.lit(default))


def in_hours(hour: Column, spans: Iterable[tuple[int, int]]) -> Column:
    """True when the hour lies in one of the spans, both ends included."""
    hits = [hour.between(low, high) for low, high in spans]
    condition = hits[0]
    for hit in hits[1:]:
        condition = condition | hit
    return condition
