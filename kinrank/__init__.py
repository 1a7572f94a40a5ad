"""Recommendation analytics on Spark: DataFrames in, DataFrames out."""

import sys

from pyspark import cloudpickle

# Functions sent to tasks carry their code, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
