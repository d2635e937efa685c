"""ledgerloom: campaign-finance analytics as Spark plans.

Every transform is a function from DataFrame to DataFrame; nothing here collects rows to the driver except
where a docstring states a bound.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Pandas functions travel by value, so executors need no copy of this package on their path.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
