"""Operators for preparing training text: counting, joining, filtering, mixing and sharding documents."""

import sys

from pyspark import cloudpickle

# tasks get the package's functions themselves, so executors need no copy of it
cloudpickle.register_pickle_by_value(sys.modules[__name__])
