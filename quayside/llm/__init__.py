"""Operators for preparing training data: cleaning, de-duplication, mixing and encoding of text corpora.

Nothing outside this subpackage imports it. Each ``opN_*`` module holds one general operator and the thin
query registered under its name; ``registry`` collects the queries and their SQL.
"""
