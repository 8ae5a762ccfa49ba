"""Operators of a training-data pipeline (one module per operator)."""

import sys

from pyspark import cloudpickle

# Functions of this package that run in Python workers travel with the job by
# value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
