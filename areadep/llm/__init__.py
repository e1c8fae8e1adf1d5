"""Operators for building training corpora. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Tasks get these functions with their code, so that executors need not have the library installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
