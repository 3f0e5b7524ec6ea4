"""Spark-native refining of keyed order events and search over document collections."""

import sys

from pyspark import cloudpickle

# Send the package's functions to the tasks by value, so that executors need no
# copy of it on their import path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
