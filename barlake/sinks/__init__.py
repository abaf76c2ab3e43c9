"""Table writers: partitioned append with column evolution, keyed upsert."""

from barlake.sinks.append import append_partitioned
from barlake.sinks.tables import delete_path, staged, upsert_table

__all__ = ["append_partitioned", "delete_path", "staged", "upsert_table"]
