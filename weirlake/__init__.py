"""weirlake: a PySpark-native engine for curating, auditing and certifying data lakes."""

import sys

from pyspark import cloudpickle

# Functions go to the executors whole, so workers need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
