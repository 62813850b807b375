"""Operators for training-data pipelines: filters, duplicates, packing and formatting of text.

Functions that run in Python workers are pickled by value, so executors need not have
this package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
