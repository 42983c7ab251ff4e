"""Operators for building training data from text corpora.

Nothing else in the library imports this package; it imports only general helpers.

Functions that run inside Python workers are shipped by value, so executors need no copy of
the package on their import path."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
