"""Generic DataFrame -> DataFrame operators (column names are parameters)."""

from deckframe.operators.groups import (complete_groups, distinct_count, group_totals,
                                        groups_where_total, ordered_concat)
from deckframe.operators.incremental import high_water_mark, newer_than, upsert
from deckframe.operators.latest import dedupe_keep_last, latest_per_key
from deckframe.operators.ownership import fully_covered, fully_owned_groups, owned_rows
from deckframe.operators.ranking import top_k
from deckframe.operators.running import budget_cut, running_total, running_total_split
from deckframe.operators.scd2 import current, scd2_apply, scd2_step, scd2_versions

__all__ = [
    "complete_groups", "distinct_count", "group_totals", "groups_where_total", "ordered_concat",
    "high_water_mark", "newer_than", "upsert",
    "dedupe_keep_last", "latest_per_key",
    "fully_covered", "fully_owned_groups", "owned_rows",
    "top_k", "budget_cut", "running_total", "running_total_split",
    "current", "scd2_apply", "scd2_step", "scd2_versions",
]
