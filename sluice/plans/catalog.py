"""Registered queries: one Spark plan per operator, each paired with an equivalent DuckDB SQL
oracle over the same driver tables.

Every query reads whole driver tables (through the views in ``sources.driver_tables``); the
only literals are report parameters (year, zone, as-of instant, thresholds).  Doubles are
rounded on both sides so that summation order cannot change the value hash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.session import configure

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None, text_cols: tuple[str, ...] = ()):
    """Register a query.  ``text_cols`` (DATE columns) are emitted as ISO ``yyyy-MM-dd`` text on
    both sides, so that the comparison does not depend on how each engine maps DATE values."""
    if sql is not None and text_cols:
        casts = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in text_cols)
        sql = f"WITH __q AS ({sql}) SELECT * REPLACE ({casts}) FROM __q"

    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            df = fn(spark, sf_dir)
            for c in text_cols:
                df = df.withColumn(c, F.col(c).cast("string"))
            return df
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        _QUERIES[name] = run
        if sql is not None:
            _SQL[name] = sql
        return run
    return deco


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)


def _load() -> None:
    # Importing the modules registers their queries.
    from sluice.plans import q_flow  # noqa: F401
    from sluice.plans import q_dashboards  # noqa: F401
    from sluice.plans import q_schedule  # noqa: F401
    from sluice.plans import q_ingest  # noqa: F401
    from sluice.plans import q_blocks  # noqa: F401
    from sluice.plans import q_alerts  # noqa: F401
    from sluice.plans import q_quality  # noqa: F401
    from sluice.plans import q_summary  # noqa: F401
    from sluice.plans import q_units  # noqa: F401
