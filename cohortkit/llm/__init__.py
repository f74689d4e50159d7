"""Operators of a training-data pipeline over document tables (one module per operator).

Functions that run inside Spark tasks are pickled by value, so executors need no copy of the package. Such a
function names what it uses of other modules directly, not as ``module.name``: a module would bring its imports.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
