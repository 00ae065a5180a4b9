"""Operators for preparing language-model training text; nothing else in the package imports them.

Functions of this subpackage travel to the executors by value, so that these need no copy of
the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
