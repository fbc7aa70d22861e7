"""Operators for preparing training data; nothing outside this package imports it.

Task functions travel to the executors by value, so a cluster needs no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
