"""quillpair: Spark-native analytics for tables of text pairs.

Profiling, cleaning, keyword ranking, prompt and feature building,
pluggable batch generation, candidate selection and text-generation
metrics, all expressed as DataFrame / Column operations.
"""

import sys as _sys

__version__ = "0.1.0"

# Ship the package's Python helpers with each UDF (pickled by value), so
# executors need no copy of the package on their path.
try:
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001  (older cloudpickle: rely on --py-files)
    pass
