"""Match and player statistics as PySpark DataFrame operations."""

from matchstats.sources.tables import StatsTables, open_tables
from matchstats.session import tune

__all__ = ["StatsTables", "open_tables", "tune"]
