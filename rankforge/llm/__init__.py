"""Training-data operators. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Tasks get the operators' functions by value, so executors need not have this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
