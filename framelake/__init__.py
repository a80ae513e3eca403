"""Detection-data analytics as PySpark DataFrame and Column functions."""

import sys

from pyspark import cloudpickle

# functions of the package travel to the executors by value, so it need not be installed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])
