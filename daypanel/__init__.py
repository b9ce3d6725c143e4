"""Daily panels and next-day multi-label sequences as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the Python workers whole, so the executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
