"""Latest version per key (ties kept) and keep-last de-duplication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deckframe.operators.util import as_list


def latest_per_key(df: DataFrame, keys, version: str, method: str = "semi") -> DataFrame:
    """Rows whose ``version`` equals the newest version of their ``keys`` group.

    Ties on the newest version are all kept; rows with a NULL key or NULL
    version never qualify (equality semantics).

    ``method="semi"`` (default): newest version per key by aggregation (partial
    aggregation on the map side, so a hot key costs one row per task), then a
    left-semi join on (keys, version).  A hot key on the probe side is split by
    adaptive skew-join handling.  ``method="window"``: one shuffle with
    ``max().over(partitionBy(keys))`` -- cheaper when every group is known to be
    small (a deck board), but a single hot key lands in one task.
    """
    keys = as_list(keys)
    if method == "window":
        from pyspark.sql import Window
        w = Window.partitionBy(*keys)
        newest = F.max(version).over(w)
        return (df.withColumn("__newest", newest)
                  .filter((F.col(version) == F.col("__newest")) & _all_not_null(keys))
                  .drop("__newest"))
    newest = (df.where(_all_not_null(keys))
                .groupBy(*keys).agg(F.max(version).alias(version)))
    return df.join(newest, on=keys + [version], how="left_semi").select(*df.columns)


def _all_not_null(cols):
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def _orderable(dt: T.DataType) -> bool:
    if isinstance(dt, (T.MapType, T.VariantType)):
        return False
    if isinstance(dt, T.ArrayType):
        return _orderable(dt.elementType)
    if isinstance(dt, T.StructType):
        return all(_orderable(f.dataType) for f in dt.fields)
    return True


def dedupe_keep_last(df: DataFrame, keys, order_by, keep: str = "last") -> DataFrame:
    """One row per ``keys``: the row that sorts last (or first) by ``order_by``.

    Ties on ``order_by`` are broken by every other orderable column, so the
    result does not depend on input order (Spark has no file order).
    The row itself is the largest (smallest) struct of ordering and remaining
    columns, so each column is carried once; the aggregate is partial: a key
    holding a third of all rows is reduced to one row per task before the
    shuffle.
    """
    keys = as_list(keys)
    order = as_list(order_by)
    rest = [f for f in df.schema.fields if f.name not in keys and f.name not in order]
    plain = [f.name for f in rest if _orderable(f.dataType)]
    other = [f.name for f in rest if not _orderable(f.dataType)]
    rank = F.struct(*[F.col(c) for c in order + plain])
    if other:  # columns without an order travel beside the ones that rank
        row = F.struct(rank.alias("r"), *[F.col(c) for c in other])
        pick = F.max_by(row, rank) if keep == "last" else F.min_by(row, rank)
    else:
        pick = F.struct((F.max(rank) if keep == "last" else F.min(rank)).alias("r"))
    out = df.groupBy(*keys).agg(pick.alias("__row"))
    at = {c: F.col("__row")["r"][c] for c in order + plain} | {c: F.col("__row")[c] for c in other}
    return out.select(*[(F.col(c) if c in keys else at[c]).alias(c) for c in df.columns])
