from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def as_column(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _bound(step: Callable[[ColumnOrName], Column]) -> Callable[[Column], Column]:
    return lambda value: step(value)


def chain(c: ColumnOrName, *steps: Callable[[ColumnOrName], Column]) -> Column:
    """The steps one after the other, each evaluated once per row.

    A step that uses its argument several times would otherwise hold as many copies of all
    steps before it. Binding the argument to a lambda variable avoids that inside one
    expression; a job over a whole table had better use ``add_computed``.
    """
    value = as_column(c)
    for step in steps:
        value = F.get(F.transform(F.array(value), _bound(step)), F.lit(0))
    return value
