"""Operators for building training corpora out of documents and pages."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to executors by value: a cluster need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
