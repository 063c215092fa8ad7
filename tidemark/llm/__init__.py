"""Operators for preparing training text.

Functions that run inside tasks are sent to executors by value, so a cluster's Python
needs numpy and pyarrow but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
