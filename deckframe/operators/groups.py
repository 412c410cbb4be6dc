"""Group totals, completeness filters and ordered string aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deckframe.operators.util import as_list

_COMPARE = {
    "==": lambda c, v: c == v,
    "<=": lambda c, v: c <= v,
    ">=": lambda c, v: c >= v,
    "<": lambda c, v: c < v,
    ">": lambda c, v: c > v,
}


def compare(left, op: str, right):
    """``left <op> right`` for the operators ``== <= >= < >``."""
    return _COMPARE[op](left, right)


def group_totals(df: DataFrame, group, quantity: str, alias: str = "total") -> DataFrame:
    """``SUM(quantity)`` per group (partial aggregation before the shuffle)."""
    return df.groupBy(*as_list(group)).agg(F.sum(quantity).alias(alias))


def groups_where_total(df: DataFrame, group, quantity: str, size, op: str = "==",
                       alias: str = "total") -> DataFrame:
    """Groups (with their total) whose quantity total satisfies ``total <op> size``."""
    totals = group_totals(df, group, quantity, alias)
    return totals.filter(_COMPARE[op](F.col(alias), F.lit(size)))


def complete_groups(df: DataFrame, group, quantity: str, size=100, op: str = "==") -> DataFrame:
    """All rows of the groups whose quantity total satisfies ``total <op> size``.

    ``HAVING SUM(q) = size`` + ``IN (subquery)`` as aggregate + left-semi join;
    NULL group keys never qualify, as with ``IN``.
    """
    group = as_list(group)
    ok = groups_where_total(df, group, quantity, size, op).select(*group)
    return df.join(ok, on=group, how="left_semi").select(*df.columns)


def ordered_concat(df: DataFrame, group, value: str, sep: str, alias: str | None = None) -> DataFrame:
    """``group_concat(value ORDER BY value SEPARATOR sep)`` per group; NULLs skipped.

    The per-group buffer holds the group's values, so use it on groups that are
    small by construction (commanders of one deck).
    """
    alias = alias or value
    agg = F.expr(f"listagg(`{value}`, '{sep}') WITHIN GROUP (ORDER BY `{value}`)")
    return df.groupBy(*as_list(group)).agg(agg.alias(alias))


def distinct_count(df: DataFrame, group, value: str, alias: str = "count") -> DataFrame:
    """``COUNT(DISTINCT value)`` per group (exact)."""
    return df.groupBy(*as_list(group)).agg(F.count_distinct(value).alias(alias))
