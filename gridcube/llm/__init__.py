"""Training-data operators: one module per operator, plus ``queries`` (the
registered ``opN_*`` queries) and ``components`` (connected components).

Nothing else in the library imports this subpackage. Its Python kernels are
shipped to the executors by value, so a cluster needs numpy, pyarrow, xxhash
and tiktoken installed but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
