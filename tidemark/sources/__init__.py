from tidemark.sources.landing import landed_days, missing_days, quarantine, read_days, require_days, typed
from tidemark.sources.seeds import read_seed
from tidemark.sources.snapshots import Snapshots
from tidemark.sources.tables import Warehouse, together

__all__ = [
    "Snapshots", "Warehouse", "landed_days", "missing_days", "quarantine", "read_days", "read_seed", "require_days", "together",
    "typed",
]
