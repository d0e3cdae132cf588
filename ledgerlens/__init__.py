"""ledgerlens: PySpark operators for transaction-risk data.

Every function takes DataFrames and returns DataFrames; the logical plan is
declared with the DataFrame API and left to Catalyst and AQE.
"""

import sys

from pyspark import cloudpickle

# Functions of the package travel to the executors by value, so a worker needs no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
