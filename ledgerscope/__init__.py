"""ledgerscope: transaction-monitoring operators expressed as Spark DataFrame plans.

Every public operator takes DataFrames and returns an unevaluated DataFrame;
actions happen only where a scalar must be known to build the next plan
(model fitting, min/max normalisers) or when the caller collects/writes.
"""

import sys as _sys

__version__ = "0.1.0"

# Python functions run by Spark tasks (Arrow kernels, grouped functions) are
# shipped with their code, so executors need no installed copy of this package.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older pyspark without the hook
    pass
