"""fieldline: leak-free sports feature engineering as composable Spark DataFrame operators.

Sub-packages
------------
functions   pure Column expressions (odds, rates, hashes, lenient casts, null normalisation)
operators   DataFrame -> DataFrame operators (rollups, rolling windows, joins, dedup, merges, quality)
sources     readers for landed payloads, game logs, calendars and Parquet tables; table writers
plans       the views and registered queries over the driver tables, plus the batch jobs
streaming   Structured Streaming ingestion that reuses the batch operators per micro-batch
"""

from fieldline.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
