"""Operators of a large-scale training-data pipeline; nothing else in the library imports them.

The functions that run in tasks are sent by value, so executors need not have this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
