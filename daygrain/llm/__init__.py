"""Operators for preparing training data. Nothing outside this folder imports it."""

import sys

from pyspark import cloudpickle

# Python functions of this package travel with the tasks, so executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
