"""Operators for preparing training text.

Executors need not have this package on their path: its functions travel to the
Python workers by value.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
