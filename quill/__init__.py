"""quill: PySpark DataFrame operators for text similarity (TF-IDF, sparse
cosine, best match, category matrices), review ranking (daily counts, brands,
top-k) and recommendation (play-time ratings, fusion with sentiment or a
recommend flag, user indexing, implicit ALS).

Subpackages: ``functions`` (column expressions), ``operators`` (DataFrame in,
DataFrame out), ``sources`` (file readers and writers), ``plans`` (test-table
views, the query catalogue and its DuckDB twins) and, optional, ``llm`` (operators
for training-data pipelines).
"""

__version__ = "0.1.0"
