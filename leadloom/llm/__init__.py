"""Operators for preparing training data. Nothing else in the library imports this subpackage.

Functions of this subpackage travel to Python workers by value, so workers need no copy of the library.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
