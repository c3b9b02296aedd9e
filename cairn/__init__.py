"""cairn: composable, lazily evaluated PySpark operators for preparing business
tables and analysing customers at scale."""

import sys as _sys

__version__ = "0.1.0"

# Functions of this package that run inside tasks (mapInPandas writers, user
# transformations) are pickled by value, so executors need nothing installed.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle: ship the package instead
    pass
