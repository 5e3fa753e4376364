"""Operators for preparing language-model training data, and their registered queries.

Nothing else in the package imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Functions that run in tasks are shipped by value, so executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
