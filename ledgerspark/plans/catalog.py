"""All registered queries; importing a module registers its queries."""

from ledgerspark.plans import (  # noqa: F401
    aggregates,
    apportion,
    changelog,
    documents,
    files,
    ledger,
    relational,
    scalars,
    streaming,
    sync,
    windows,
)
from ledgerspark.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
