"""Training-data operators.

Worker functions of this package travel to the executors by value, so executors need the
third-party libraries only and no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
