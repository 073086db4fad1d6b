"""Building blocks for the DuckDB oracle SQL (the driver registers the parquet tables as views)."""

from __future__ import annotations

from sluice.sources.driver_tables import OBJECTS_SQL, READINGS_SQL, SCHEDULE_SQL

# Demo report parameters shared by the Spark queries and their oracles.
TZ = "America/Los_Angeles"
YEAR = 2024
END = "2024-03-31"
# Dashboard range: covers the whole events table (30 days from 2024-01-01).
RANGE_FROM = "2024-01-01 00:00:00"
RANGE_TO = "2024-02-01 00:00:00"
# "now" for alerts and due-date windows (explicit, never the wall clock).
AS_OF = "2024-01-31 12:00:00"
AS_OF_DATE = "1998-06-01"


def with_views(*names: str) -> str:
    parts = {"readings": READINGS_SQL, "objects": OBJECTS_SQL, "schedule": SCHEDULE_SQL}
    return "WITH " + ",\n".join(f"{n} AS ({parts[n]})" for n in names)


def local(ts: str, tz: str = TZ) -> str:
    """Wall-clock TIMESTAMP in ``tz`` of a naive-UTC timestamp."""
    return f"timezone('{tz}', timezone('UTC', {ts}))"


def utc_of_local(literal_ts: str, tz: str = TZ) -> str:
    """Naive-UTC instant of a local wall-clock literal."""
    return f"CAST(timezone('UTC', timezone('{tz}', TIMESTAMP '{literal_ts}')) AS TIMESTAMP)"


def ms(ts: str) -> str:
    """Millisecond epoch with floor semantics (DuckDB epoch_ms rounds)."""
    return f"(epoch_us({ts}) // 1000)"


def rnd(x: str, d: int = 4) -> str:
    """Half-up rounding with the same double operations as ``functions.dates.round_half_up``."""
    f = 10 ** d
    return f"(floor(({x}) * {f}.0 + 0.5) / {f}.0)"
