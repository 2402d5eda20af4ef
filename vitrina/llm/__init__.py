"""Operators for preparing training data: texts, web pages, tokens, mixtures and shards.

Nothing outside this package imports it.  Each module holds one operator with a
general interface; ``queries`` applies the operators to the given tables.
"""
