"""loomsift: turns messy tabular files into one clean, deduplicated, auditable table on Spark."""

import sys

from pyspark import cloudpickle

# Python workers get the package's functions by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
