"""Spark-native document and table ingest: one searchable document table."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to executors by value: nothing to install there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
