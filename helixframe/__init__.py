"""Spark-native analytics for genome-scale intervals, sequences and signals."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to executors by value, so a cluster needs no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
