"""Operators for preparing training text; nothing outside this folder imports them."""

import sys

from pyspark import cloudpickle

# Tasks carry these functions themselves: executors need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
