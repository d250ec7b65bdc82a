"""skytrace: GNSS receiver telemetry (NMEA + UBX) as Spark DataFrame jobs."""

import sys as _sys

__version__ = "0.1.0"

try:  # ship the package's Python helpers (pandas folds) by value: executors need no install
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle
    pass
