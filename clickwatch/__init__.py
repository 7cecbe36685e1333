"""Ad-clickstream anomaly analytics as DataFrame and Structured Streaming jobs."""

import sys

from pyspark import cloudpickle

# Functions used in tasks travel by value, so workers need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
