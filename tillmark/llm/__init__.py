"""Operators for preparing training text, each over whole tables."""

import sys

from pyspark import cloudpickle

# Functions for Python workers travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
