"""Retail analytics as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Grouped-map functions travel to the executors by value, so workers need not have
# this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
