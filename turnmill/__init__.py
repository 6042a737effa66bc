"""turnmill: conversation and instruction training data on Spark DataFrames."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions sent to Python workers travel whole, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
