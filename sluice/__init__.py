"""sluice: Spark-native analytics for utility-meter telemetry and water compliance.

Layout
------
functions/   Column-expression builders (timestamps, numbers, header → metric rules, dates)
sources/     readers: object manifests, gzip logs, schedule CSVs, config dims, driver tables
operators/   DataFrame → DataFrame operators (structuring, melt, flow maths, dashboards,
             schedule analytics, alerts, quality checks, replay/correction)
sinks/       idempotent table writers (registry, records, readings, checkpoints, schedule)
plans/       end-to-end batch jobs (ingest, diversion report, alert bundle) and the
             registered query catalogue used by ``__spark_entry__``
streaming/   Structured Streaming ingest and stateful alert operators

Every operator takes and returns DataFrames; clocks, time zones, windows and thresholds
are explicit arguments.
"""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel by value: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from sluice.session import configure, checkpoint_dir, local_session  # noqa: E402, F401

__all__ = ["configure", "checkpoint_dir", "local_session"]
