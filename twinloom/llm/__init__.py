"""Operators of a training-data pipeline over documents, pages, labels and vectors."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with their code, so that executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
