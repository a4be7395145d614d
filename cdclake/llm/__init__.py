"""Operations of a training-data pipeline on tables of documents, pages and embeddings.

Tasks get the functions of this package with the job, not by import, so executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
