"""Training-data pipeline operators; nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Batch kernels travel to the Python workers by value, so executors need no copy of this
# package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
