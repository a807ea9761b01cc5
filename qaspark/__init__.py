"""Question-answering data engine on PySpark: preparation, retrieval, reader features, scoring."""

import sys

from pyspark import cloudpickle

# functions sent to the executors carry their code along, so the package need not be installed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])
