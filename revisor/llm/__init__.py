"""Operators of a training-data pipeline (documents, pages, benchmark items).

Each operator is a module with a general interface; ``queries`` holds the
thin registered queries and their SQL.  Nothing outside this folder imports it
except the guarded hook in ``__spark_entry__.py`` and ``corpus_pipeline.py``.
"""
