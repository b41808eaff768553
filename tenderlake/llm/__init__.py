"""Operations of a training-data pipeline: ten operators and their queries.

Nothing else in the library imports this subpackage.  Its functions are
pickled by value, so workers need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
