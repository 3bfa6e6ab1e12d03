"""tokenloom: corpus preparation and evaluation scoring as Spark DataFrame jobs.

Layout
------
functions   column expressions (text, tokens, hashing, scoring)
operators   DataFrame -> DataFrame building blocks (ordering, index, packing, mixing, evaluation)
sources     readers and writers (raw corpora, token tables, completion ledger)
plans       jobs assembled from operators (prepare a corpus, feed training, sweep evaluations)
streaming   the incremental versions of ingest, tokenize and pack
"""

__version__ = "0.1.0"
