"""gridcube — Spark-native monthly indicator cube.

Layout:
  functions/  Column -> Column expressions and driver-side header helpers
  operators/  DataFrame -> DataFrame operators (cleaning, indicators, cube,
              statistics, quality checks, models, lookups)
  sources/    file scans, month handling, source registry, sinks
  streaming/  incremental (file-stream) ingest
  plans/      runnable queries over the driver's TPC-H-style tables
"""

__version__ = "0.1.0"

import sys

from pyspark import cloudpickle

# the Arrow kernels go to the executors by value, so that these need numpy and pyarrow but not this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
