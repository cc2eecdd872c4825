"""Operators for text corpora: language, near copies, packing, fingerprints, search, tokens, quality, WARC and shards.

Nothing outside this package imports it.  Each module has one operator with a general interface; ``queries``
registers the catalogue queries and ``corpus_pipeline.py`` at the repository top chains four of the operators.
"""
