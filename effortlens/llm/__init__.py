"""Operators that prepare training text: one module per operator, one query per operator."""

import sys

from pyspark import cloudpickle

# Functions of this package travel inside the tasks that call them, so executors need no copy
# of it on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
