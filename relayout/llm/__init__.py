"""Training-data operators: ten operators over documents, labels and embeddings (see README).

Nothing outside this folder, ``corpus_pipeline.py`` and ``tests/llm`` imports it. The functions that
run inside tasks are shipped with the job (pickled by value), so executors need no copy of this
package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
