"""Operators for preparing training text. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so a worker needs no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
