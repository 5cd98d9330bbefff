"""pulsegrid: windows of sensor samples -> features -> linear models, on Spark.

Kernels that run inside Python workers (``mapInArrow``) are pickled by value,
so executors need no installed copy of this package.
"""

import sys as _sys

try:
    from pyspark import cloudpickle as _cp
    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle
    pass

__version__ = "0.1.0"
