"""Daily behavioural indicators from phone and wearable datapoints, on Spark."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to Python workers by value, so that workers,
# streaming ones included, need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
