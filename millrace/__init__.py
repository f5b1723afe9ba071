"""Event-stream and table analytics on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions and classes of this package travel to Python workers as code, so no worker needs it installed; that includes
# the processes Spark starts on the driver for streaming sources and state, which know no added files.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
