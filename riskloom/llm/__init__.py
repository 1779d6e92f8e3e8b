"""Operators for preparing training text; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks are sent whole, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
