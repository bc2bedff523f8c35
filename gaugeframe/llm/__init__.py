"""Operators for preparing training data. Nothing else in the library imports this package.

Each module holds one operator with its general interface and the registered query on top of it.
"""

import sys

from pyspark import cloudpickle

# Functions run on executors travel with their code, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
