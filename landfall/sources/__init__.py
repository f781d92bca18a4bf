"""Raw feeds, lake tables and where they lie."""

from landfall.sources.feeds import read_arrivals, read_feed, unread_report
from landfall.sources.layout import LakeLayout, RawLayout
from landfall.sources.snapshots import Snapshot, Transaction, adopt, expire, snapshot
from landfall.sources.tables import read_months, read_table, write_months, write_table

__all__ = [
    "LakeLayout",
    "RawLayout",
    "Snapshot",
    "Transaction",
    "adopt",
    "expire",
    "read_arrivals",
    "read_feed",
    "read_months",
    "read_table",
    "snapshot",
    "unread_report",
    "write_months",
    "write_table",
]
