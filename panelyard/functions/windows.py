"""Windows over one entity's rows in time order; one exchange by entity serves all of them."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

KEY, TIME = "loan_id", "reporting_month"
_FIRST, _LAST = Window.unboundedPreceding, Window.unboundedFollowing


def by_entity(key: str = KEY, time: str = TIME):
    return Window.partitionBy(key).orderBy(time)


def trailing(k: int, w=None):
    """The current row and the k - 1 before it."""
    return (w or by_entity()).rowsBetween(-(k - 1), 0)


def to_date(w=None):
    return (w or by_entity()).rowsBetween(_FIRST, 0)


def before(w=None):
    return (w or by_entity()).rowsBetween(_FIRST, -1)


def ahead(k: int, w=None):
    """The next k rows, without the current one."""
    return (w or by_entity()).rowsBetween(1, k)


def forward_any(flag: Column, k: int) -> Column:
    """Whether the flag is set in the next k rows; nulls are ignored; null without such rows."""
    return F.max(flag.cast("int")).over(ahead(k))


def rows_ahead(k: int) -> Column:
    """How many of the next k rows there are."""
    return F.count(F.lit(1)).over(ahead(k))


def filled(c: Column) -> Column:
    """Nulls take the last value before them, else the first after."""
    w = by_entity()
    return F.coalesce(c, F.last(c, ignorenulls=True).over(w.rowsBetween(_FIRST, 0)), F.first(c, ignorenulls=True).over(w.rowsBetween(0, _LAST)))


def since(flag: Column, at: Column) -> Column:
    """``at`` minus its value where the flag was last true, the current row included; null if never."""
    return at - F.last(F.when(flag, at), ignorenulls=True).over(to_date())
