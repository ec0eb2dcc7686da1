"""Text data preparation, scoring and response generation as Spark jobs.

The package is a set of DataFrame-to-DataFrame operators:

* ``functions``  column builders (no I/O, no actions)
* ``operators``  row-set operators: filters, resume joins, ordinals, unions, reports, model calls
* ``sources``    readers, writers and file listings
* ``plans``      whole jobs put together from the parts above
* ``streaming``  incremental variants on file-source streams
"""

import sys

from pyspark.cloudpickle.cloudpickle import register_pickle_by_value

from millrace.session import build_session, staging_dir

# Functions that run inside tasks travel with the query, so executors do not need
# this package installed.
register_pickle_by_value(sys.modules[__name__])

__all__ = ["build_session", "staging_dir"]
