"""Operators for large training corpora: filters, deduplication, scoring, sharding, search.

What runs in tasks is sent by value, so executors need not have this package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
