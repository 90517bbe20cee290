"""Operators of a training-data pipeline over document tables.

Nothing outside this subpackage imports it; its queries are in ``llm.queries``.
Functions that run in Python workers travel by value, so executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
