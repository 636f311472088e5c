"""Run parameters shared by every layer."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Config:
    """One object for schema names, load stamps and tuning knobs.

    Load stamps are injected instead of ``current_timestamp()`` so a rerun of the
    same job writes the same rows (idempotent retries after an executor loss).
    """

    # layer namespaces in the session catalog
    bronze_schema: str = "bronze"
    silver_schema: str = "silver"
    gold_schema: str = "gold"

    # load stamp of the full (initial) load; timestamp_ntz text. None = the wall
    # clock, captured once per run (see ``resolved``)
    run_ts: str | None = "2002-01-01 00:00:00"
    # incremental scenario: first load at initial_ts, merge at incremental_ts
    initial_ts: str = "1999-01-01 00:00:00"
    incremental_ts: str = "2002-01-01 00:00:00"

    # skew handling
    heavy_key_threshold: int = 60
    salt_buckets: int = 10
    # keys treated apart by the skew joins: fewer than this many, each with more than its
    # inverse share of all rows (and more than heavy_key_threshold)
    most_hot_keys: int = 10_000
    # largest side (bytes) we ever broadcast; anything above takes the shuffle path
    max_broadcast_bytes: int = 64 << 20

    # layout: keyed tables (silver entities, gold dimensions) are bucketed on their
    # key so merges and dimension joins shuffle only the other side. None = the largest
    # source's bytes / target_file_bytes, at least the session's
    # spark.sql.shuffle.partitions (a bucket count below it makes the planner reshuffle
    # both sides, so the bucketing would be wasted)
    buckets: int | None = None
    # bytes of a bucket and of a repartitioned task; a file that one task sorts (z-ordered,
    # clustered) has an eighth of it
    target_file_bytes: int = 256 << 20

    # independent table jobs (one per entity / mart) submitted at once from driver
    # threads; each is still an ordinary distributed job
    parallel_jobs: int = 4

    # snapshot retention
    retention_hours: int = 168

    def resolved(self) -> "Config":
        """A copy with ``run_ts`` fixed: one stamp for every table of the run, so a
        retried job rewrites the same values."""
        if self.run_ts is not None:
            return self
        return replace(self, run_ts=_dt.datetime.now().strftime("%Y-%m-%d %H:%M:%S"))
