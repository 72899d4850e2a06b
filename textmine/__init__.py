"""textmine: text analytics as Spark DataFrame operators.

Every operator takes DataFrames and returns a DataFrame without running a
job (the exceptions say so in their docstring), so Catalyst sees and plans
the whole query: filters reach the parquet scan, aggregations are partial
before each shuffle, and lexicon joins broadcast only sides whose size is
known.

Sub-packages:

* ``sources``   - corpus tables, lines, lexicons, stop words, matrices
* ``functions`` - Column-level helpers (word pattern, buckets, clean-ups)
* ``operators`` - tokenising, verbs, tf-idf, sentiment, n-grams,
  pairwise statistics, topic models, statistics
* ``plans``     - the registered queries and their SQL equivalents
* ``streaming`` - the stateless operators applied to a streaming source
"""

from textmine.session import ensure_checkpoint_dir, get_spark

__all__ = ["ensure_checkpoint_dir", "get_spark"]
