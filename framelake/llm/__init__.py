"""Operators for large-scale training-data preparation.

Functions of this package travel to the executors by value, so the repository need not be installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
