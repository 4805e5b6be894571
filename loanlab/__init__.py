"""loanlab: default-risk analytics on Spark DataFrames.

Subpackages
-----------
sources    reading/writing tables, model and codebook persistence, test fixtures
functions  column-level helpers (parsing, value maps, the partition-independent hash)
operators  cleaning, missing data, encoding, profiling, sampling, metrics, models,
           ensembles, selection, explanation, self-organizing map
plans      end-to-end flows and the query/oracle registry used by ``__spark_entry__``
llm        training-data operators; nothing else here imports it
"""

__version__ = "0.1.0"
