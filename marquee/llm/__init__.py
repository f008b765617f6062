"""Operations of a training-data pipeline over documents, pages and conversations.

Nothing outside this package imports it. Functions that run inside tasks travel
by value, so the executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
