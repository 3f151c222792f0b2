"""Operators for preparing training text: one module each, all over plain DataFrames.

Nothing outside this package imports it. `queries` registers one query per operator.
"""

import sys

from pyspark import cloudpickle

# What tasks run travels with the plan, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
