"""Pluggable ways to build change keys and payloads, as Column expressions."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from docweave.operators.changes import change_tag, tag_base

KeyFunction = Callable[[Column, Column, Column, Column], Column]


@dataclass(frozen=True)
class Strategy:
    """``tag`` names a change; ``queue_tag`` names the job its key is compacted under."""

    tag: KeyFunction
    queue_tag: Callable[[Column, Column, Column], Column]


_STRATEGIES: dict[str, Strategy] = {}


def register_strategy(name: str, tag: KeyFunction, queue_tag: Callable[[Column, Column, Column], Column]) -> None:
    """Make a strategy available to rules under a name; names ignore case."""
    _STRATEGIES[name.lower()] = Strategy(tag, queue_tag)


def strategy(name: str = "") -> Strategy:
    """A registered strategy; the empty name is the default one."""
    wanted = name.lower() or "segmented"
    if wanted not in _STRATEGIES:
        raise ValueError(f"no such strategy: {name}")
    return _STRATEGIES[wanted]


def _queue_tag(db: Column, tbl: Column, action: Column) -> Column:
    return F.concat(tag_base(db, tbl), F.when(action == "delete", F.lit("_delete")).otherwise(F.lit("")))


register_strategy("segmented", change_tag, _queue_tag)
