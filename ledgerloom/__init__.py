"""ledgerloom: Spark-native cleaning of messy transaction tables and spending reports.

Every stage is a DataFrame -> DataFrame job built from Catalyst expressions,
broadcast joins of small dimension tables and partial/final aggregations:

* ``sources``   - CSV ingest, dimension tables, the driver-table view, sinks
* ``functions`` - column expressions (dates, amounts, merchant text, money)
* ``operators`` - merchant resolution, categorisation, FX conversion, report
* ``plans``     - end-to-end pipelines and the registered query set
* ``streaming`` - the stateless stages applied to a streaming source
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# The few Arrow functions (NFKC, fuzzy scoring) are defined in this package.
# Pickle the package by value so executors need no installed copy of it.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

from ledgerloom.session import checkpoint_dir, get_spark  # noqa: E402

__all__ = ["get_spark", "checkpoint_dir"]
