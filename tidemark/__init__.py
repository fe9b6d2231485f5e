"""tidemark: change-feed analytics on Spark.

Append-only ingest of change envelopes, read-time current state, soft
invalidation, audits and set-based mutation batches, all as DataFrame / SQL /
Structured Streaming operations.
"""

from .operators.ingest import to_silver
from .operators.state import current_state, latest_changes, winners
from .schemas import ACCOUNTS, TableSpec
from .session import build_session, configure
from .table import ChangeTable

__all__ = [
    "to_silver",
    "current_state",
    "latest_changes",
    "winners",
    "build_session",
    "configure",
    "ChangeTable",
    "TableSpec",
    "ACCOUNTS",
]
