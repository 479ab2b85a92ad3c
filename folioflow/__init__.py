"""Spark-native document analytics: hierarchies, references, structure, retrieval and evaluation over corpora."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# functions travel to the executors with what they use, so the library need not be installed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])
