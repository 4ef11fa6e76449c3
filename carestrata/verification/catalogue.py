"""All verification queries; importing a module registers its queries."""

from carestrata.verification import gold, landing, odd_input, provider_tables, quality, silver, stored_state, whole_jobs, wide_files  # noqa: F401
from carestrata.verification.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
