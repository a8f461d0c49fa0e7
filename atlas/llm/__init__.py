"""Operators for preparing large training corpora, one module each.

Functions of this package travel to Python workers by value: executors need the public libraries, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
