"""Operators of a training-data pipeline: near-duplicate search, line and passage
dedup, quality models and rules, sharding, packing and token coding.

Nothing outside this folder imports it, except the guarded hook in
``__spark_entry__.py`` and ``corpus_pipeline.py``."""
