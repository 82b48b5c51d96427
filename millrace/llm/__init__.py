"""Operators for preparing training corpora, one module each.

Functions of this package travel to the Python workers by value, so executors need
numpy and pyarrow but not the package itself.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
