"""regalign: company-record harmonisation as Spark DataFrame operators.

Sub-packages:
  functions  column expressions (name normalisation, ids, fuzzy ratios)
  operators  DataFrame -> DataFrame operators (matching, ranking, quality,
             upsert and time travel, model training and evaluation)
  sources    delimited-file scans and the registry table layout
  plans      end-to-end pipeline and the driver query catalogue
"""

__version__ = "0.1.0"

# Functions this package hands to Spark (the Arrow LCS kernel run by ``mapInArrow``) are
# pickled by value, so executors need no copy of the package on their Python path.
# Without this, a job started from any directory other than the package's own fails on
# the executors with "No module named 'regalign'".  (On a cluster, shipping the package
# with ``--py-files`` works as well.)
try:
    import sys as _sys

    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001 - no pyspark or an old cloudpickle: rely on --py-files
    pass
