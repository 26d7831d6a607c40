"""A PySpark-native engine for curating speech and text corpora."""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel by value, so a cluster needs no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
