"""Small helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Broadcast policy: joins are planned without hints.  The planner broadcasts a
# side whose file size is known to be small, and adaptive execution one whose
# measured size is below ``spark.sql.adaptive.autoBroadcastJoinThreshold``; both
# bounds are in bytes and cost no extra job.  Larger sides are shuffled and skewed
# partitions split.


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_list(x) -> list:
    if x is None:
        return []
    if isinstance(x, (str, Column)):
        return [x]
    return list(x)
