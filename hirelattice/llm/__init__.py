"""Operators of a training-data pipeline: sharding, de-duplication, filters, packing, scoring, coding, counts.

Nothing outside this package imports it. Every module holds one operator with a general interface;
``queries`` applies them to the given tables and ``corpus_pipeline.py`` chains five of them.
"""
