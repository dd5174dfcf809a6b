"""Operators that prepare text corpora for language-model training.

Nothing outside this package imports it. The functions that run in Python workers travel
inside the task (pickled by value), so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
