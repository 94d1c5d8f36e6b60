"""Early-warning analytics as Spark DataFrame operators.

Every public operator takes DataFrames plus column names and returns a lazy DataFrame.
"""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel with their code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
