"""Operators for preparing large text corpora; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with the job, so that a
# cluster needs no copy of the package on its workers.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
