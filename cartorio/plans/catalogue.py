"""The registered queries and the SQL each must agree with."""

from cartorio.plans import q_aggregates, q_codes, q_joins, q_more, q_sources, q_stored, q_sync, q_windows  # noqa: F401
from cartorio.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
