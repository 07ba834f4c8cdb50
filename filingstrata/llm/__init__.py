"""Operators of a training-data pipeline: one module each, with the queries in :mod:`.queries`."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to Python workers by value, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
