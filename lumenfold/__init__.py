"""lumenfold: a context index for many users at once, built on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions run on executors travel by value: executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
