"""The registered queries: library operators and models run on the given benchmark tables."""

from tidemark.workload import jobs, models, operators  # noqa: F401  (registration)
from tidemark.workload.catalog import QUERIES

__all__ = ["QUERIES"]
