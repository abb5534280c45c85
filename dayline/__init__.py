"""Spark-native analytics over dated text items, history tables and run logs."""

import sys

from pyspark import cloudpickle

# Arrow functions travel to the executors by value: no install step there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
