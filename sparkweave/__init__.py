"""Analytics operators written directly on Apache Spark."""

import sys

from pyspark import cloudpickle

# functions of this package travel as values, so workers of any session need not be able to import it
cloudpickle.register_pickle_by_value(sys.modules[__name__])
