"""Operators of a training-data pipeline: tokenizing, search, language and
quality models, near-duplicates, secrets, mixing and language-model scores.

Every operator takes a DataFrame and column names and returns a DataFrame.
Per-row Python runs inside Spark tasks over Arrow batches that are cut into
slices of bounded text size; Spark partitions, shuffles and merges the work.
"""
