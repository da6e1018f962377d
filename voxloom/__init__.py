"""voxloom: transcript, interval and corpus analytics on Spark DataFrames.

Functions that run in Python workers are pickled by value, so that executors
need no copy of this package on their own path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
