"""parley — chat fine-tuning data preparation as plain Spark DataFrame functions.

Every public operator is a ``DataFrame -> DataFrame`` function (usable with
``df.transform``) or a Column expression builder.  Nothing here collects rows
to the driver; the only driver round-trips are bounded scalars (a handful of
counts used as split quotas or guard verdicts).
"""

import sys as _sys

from parley.session import build_session, work_dir

# Python workers may not have this package on their path (the driver may load
# it from a folder the executors never see).  Ship every function the package
# sends to workers (pandas UDFs, the streaming state function) by value.
try:  # pragma: no cover - depends on the PySpark build
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001
    pass

__all__ = ["build_session", "work_dir"]
