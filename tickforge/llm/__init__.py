"""Operators for large-scale training-data pipelines."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the Python workers by value: they need not be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
