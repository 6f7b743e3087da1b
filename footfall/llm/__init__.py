"""Operators for preparing training text.

Nothing else in the library imports this package. Its functions travel to the executors by value, so
that workers need no copy of it on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
