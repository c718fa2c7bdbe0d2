"""Spatial sequencing reads on Spark: barcode joins, position counts and count matrices."""

import sys

from pyspark.cloudpickle.cloudpickle import register_pickle_by_value

# Functions of this package go to executors by value, so they need no copy of it.
register_pickle_by_value(sys.modules[__name__])
