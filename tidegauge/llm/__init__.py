"""Operators for preparing training data: packing, filters, near duplicates, mixing, archives, extraction, languages."""

import sys

from pyspark import cloudpickle

# Functions for tasks travel with their job, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
