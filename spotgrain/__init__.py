"""A PySpark-native engine for molecule counts, spatial grids and corpora."""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel by value: workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
