"""Extract predicates.

A predicate set maps a column name to the value that column must equal. All terms are joined by
AND (P1); an empty set keeps every row (P2). A value is either a Python literal or an :class:`Expr`,
a SQL expression whose *value* the column must equal (P3). The expression is parsed as one
expression, so it can never widen the conjunction the way pasted SQL text could. ``None`` compares
as SQL ``= NULL``: it keeps no row.

A term on a partition column becomes a partition filter of the scan (P4): it is evaluated on the typed
partition values, and only matching folders are read. (A path table's folders are listed all the same;
a catalog table's come from the metastore.)
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..sources.tables import quote


@dataclass(frozen=True)
class Expr:
    """A SQL expression used as the right-hand side of an equality, e.g.
    ``Expr("date_format(date'2024-01-01' + 1, 'yyyy-MM-dd')")``."""

    sql: str


def equalities(predicates: Mapping[str, Any] | None) -> Column | None:
    """The conjunction ``k1 = v1 AND k2 = v2 ...``, or None for an empty set."""
    if not predicates:
        return None
    terms = []
    for name, value in predicates.items():
        rhs = F.expr(value.sql) if isinstance(value, Expr) else F.lit(value)
        terms.append(F.col(quote(name)) == rhs)
    return reduce(and_, terms)
