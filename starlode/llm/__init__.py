"""Operators for training-data pipelines. Nothing else in the library imports this package.

Functions of this package travel to Python workers by value, so that executors need no copy of
the library on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
