"""Procurement-notice mining on Spark.

Functions that Spark sends to its workers are pickled by value, so workers
need no copy of this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
