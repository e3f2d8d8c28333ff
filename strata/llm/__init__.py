"""Training-data operators: tokenising, de-duplication, scoring, extraction and search.

Nothing outside this folder (and the repository's ``corpus_pipeline.py``) imports it.  The
functions that run inside Spark tasks are pickled by value, so executors need no copy of this
package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
