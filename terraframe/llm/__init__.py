"""Operators for preparing training text: one module per operator, queries and SQL beside them."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with their code, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
