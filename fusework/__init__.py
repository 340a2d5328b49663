"""Data quality and entity resolution on Spark DataFrames."""

import sys

from pyspark import cloudpickle

from fusework.config import Settings

# the few Python functions travel with their task, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Part of the fingerprint of a run: stages of another version are not reused.
__version__ = "0.3"

__all__ = ["Settings"]
