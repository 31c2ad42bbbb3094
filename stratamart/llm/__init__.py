"""Operators for preparing training text at scale. Nothing else in the library imports them.

Functions that run inside tasks travel with the job (pickled by value), so executors need
no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
