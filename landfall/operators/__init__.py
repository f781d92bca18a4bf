"""Joins, grouping and checks that the table builders are made of."""

from landfall.operators.grouping import distinct_union, group_stats, one_row_per
from landfall.operators.joins import DEFAULT, JoinPolicy, attach_lookup, decode, join_facts
from landfall.operators.keys import key_map, keyed
from landfall.operators.places import nearest_site
from landfall.operators.quality import (
    QualityError,
    Reference,
    collected,
    differing_report,
    key_report,
    month_report,
    orphan_report,
    require_pass,
    table_report,
)

__all__ = [
    "DEFAULT",
    "JoinPolicy",
    "QualityError",
    "Reference",
    "attach_lookup",
    "collected",
    "decode",
    "differing_report",
    "distinct_union",
    "group_stats",
    "join_facts",
    "key_map",
    "key_report",
    "keyed",
    "month_report",
    "nearest_site",
    "one_row_per",
    "orphan_report",
    "require_pass",
    "table_report",
]
