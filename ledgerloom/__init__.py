"""ledgerloom: a PySpark-native evidence analytics engine.

Everything is declared with the DataFrame API and left to Catalyst; Arrow-batched Python runs only
where an algorithm is order dependent or needs vectorised numerics.
"""

__version__ = "0.1.0"

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# functions sent to Python workers travel by value, so executors need no copy of this package
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
