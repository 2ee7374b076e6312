"""Operators for training corpora. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors as code, so they run on a
# cluster on which the package isn't installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
