"""Operators for cleaning and preparing large text corpora. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the Python workers by value, so it need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
