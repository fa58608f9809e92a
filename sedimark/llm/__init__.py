"""Operators of a training-data pipeline. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel by value, so executors need no installed copy of this subpackage.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
