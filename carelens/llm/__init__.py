"""Operators for preparing text corpora: scanning, extraction, encoding,
filtering, near duplicates and mixing.

Functions that run inside tasks are sent by value, so that executors need the
libraries they use but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
