"""clickmart: clickstream analytics operators on Spark DataFrames.

Operators are plain ``DataFrame -> DataFrame`` functions (usable with
``df.transform``) built on Spark SQL, Structured Streaming and Spark ML.
Sub-packages:

* ``functions``  column expressions (``Column -> Column``) and fixed schemas
* ``sources``    readers, writers, connector options, derived inputs, the
                 stepped-counter Python data source
* ``operators``  visits, pivots, metrics, item matrices, events
* ``plans``      the composite jobs (mart, features, split, matrix, model)
* ``streaming``  the streaming jobs
"""

import sys as _sys

# Executors must run the few Python pieces (the vector pandas UDF, the
# streaming state function, the counter data source) without clickmart
# being installed on them: register the package so Spark's cloudpickle
# ships those functions and classes by value instead of by module name.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except (ImportError, AttributeError):  # older cloudpickle without the hook
    import logging as _logging

    _logging.getLogger(__name__).warning("install clickmart on the executors: it can't be shipped by value")

__all__ = ["session"]
