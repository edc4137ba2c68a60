"""Training-data operators: tokenizing, deduplication, quality, packing, scans.

Nothing else in the library imports this subpackage. Every operator takes a
``documents``-like DataFrame; the thin ``opN_*`` queries are in
:mod:`keysweep.llm.queries`.
"""
