"""Operators of a training-data pipeline: scoring, near duplicates, search,
extraction, counting, decontamination, packing, URL filters, passage removal.

Functions of this package run inside Python workers. They are pickled by
value, so executors need not have the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
