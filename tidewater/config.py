"""Lake configuration: where tables live, which table format, which clock.

Everything environment-specific is a field here so that the same jobs run on a
laptop (``local[*]``, parquet under a scratch folder) and on a cluster (object
store root, Delta if the jars are present, hundreds of shuffle partitions).
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field, replace
from typing import Optional


@dataclass(frozen=True)
class LakeConfig:
    # Root of the lake on storage every executor sees, e.g. "hdfs:///lake".
    root: str
    # "parquet" (default; versioned directories give atomic overwrite) or "delta".
    table_format: str = "parquet"
    # Fixed audit time for reproducible runs; None means current_timestamp().
    clock: Optional[_dt.datetime] = None
    # Extra column with the raw message text for rows whose parse failed.
    keep_raw_value: bool = False
    # Older table versions kept for readers still in flight.
    keep_versions: int = 2
    extra: dict = field(default_factory=dict)

    def path(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/_checkpoints/{name}"

    def with_(self, **kw) -> "LakeConfig":
        return replace(self, **kw)


# Table names of the three layers (fixed values).
BRONZE_TABLE = "user_events"
SILVER_TABLE = "user_events"
GOLD_TABLES = (
    "daily_watch_time_by_country",
    "top_content_by_watch_time",
    "hourly_event_distribution",
    "daily_device_mix",
    "user_session_summary",
)
