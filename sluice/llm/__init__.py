"""Training-data operators: decontamination, deduplication, mixing, language identification,
licence scans and preference formatting.

Nothing outside this subpackage imports it.  Functions that run in Python workers are pickled by
value, so executors do not need the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
