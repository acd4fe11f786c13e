"""Aggregation lists shared by all window operators.

Each aggregation knows three forms: over raw rows, as partial columns, and as
the merge of those partials. The two-step form lets the batch window operators
shrink the input to one row per key and time cell before any row is repeated or
any per-key ordering happens, so a key holding a third of the rows is no
heavier than its number of time cells.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

SUPPORTED = ("count", "sum", "avg", "max", "min")


@dataclass(frozen=True)
class Aggregation:
    column: str
    fn: str
    alias: str

    def _input(self) -> Column:
        return F.lit(1) if self.column == "*" else F.col(self.column)

    def direct(self) -> Column:
        return getattr(F, self.fn)(self._input()).alias(self.alias)

    def partials(self) -> list[Column]:
        name = f"__part_{self.alias}"
        if self.fn == "avg":
            return [
                F.sum(self._input().cast("double")).alias(f"{name}_sum"),
                F.count(self._input()).alias(f"{name}_n"),
            ]
        return [getattr(F, self.fn)(self._input()).alias(name)]

    def merged(self) -> Column:
        name = f"__part_{self.alias}"
        if self.fn == "avg":
            total, n = F.sum(f"{name}_sum"), F.sum(f"{name}_n")
            return F.when(n > 0, total / n).alias(self.alias)
        step = {"count": F.sum, "sum": F.sum, "max": F.max, "min": F.min}[self.fn]
        return step(name).alias(self.alias)


def aggregations(
    spec: Mapping[str, str] | Iterable[tuple[str, str, str]],
) -> list[Aggregation]:
    """Read ``{column: fn}`` or ``[(column, fn, alias), ...]``.

    With the mapping form the output is named ``<column>_<fn>``. Function names
    are case-insensitive; an unknown one raises ``ValueError``.
    """
    if isinstance(spec, Mapping):
        triples = [(c, f, f"{c}_{f.lower()}") for c, f in spec.items()]
    else:
        triples = list(spec)
    out = []
    for column, fn, alias in triples:
        if fn.lower() not in SUPPORTED or (column == "*" and fn.lower() != "count"):
            raise ValueError(f"Unsupported aggregation: {fn}")
        out.append(Aggregation(column, fn.lower(), alias))
    return out
