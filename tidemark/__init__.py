"""tidemark: incremental, crash-consistent table sharing expressed as Spark jobs."""

from tidemark.checkpoint import Checkpoint, HighWaterMark
from tidemark.contract import CASES, CUSTOMERS, DEFAULT_CONTRACTS, Contract
from tidemark.plans.sync import SyncOptions, sync
from tidemark.sources.tables import TableSource

__all__ = [
    "CASES",
    "CUSTOMERS",
    "Checkpoint",
    "Contract",
    "DEFAULT_CONTRACTS",
    "HighWaterMark",
    "SyncOptions",
    "TableSource",
    "sync",
]
