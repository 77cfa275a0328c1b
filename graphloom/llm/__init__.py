"""Training-data operators: scoring, extraction, dedup, decontamination, packing, storage.

Nothing outside this subpackage imports it.  Each module holds one operator with a
general interface; ``queries.py`` derives the registered ``opN_*`` queries from them.
"""
