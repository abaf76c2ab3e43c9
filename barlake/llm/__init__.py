"""Operators of a training-data pipeline; nothing else in the library imports them.

repetition (1), language (2), neardup (3), decontaminate (4), secrets (5),
licenses (6), line_dedup (7), chat (8), bpe (9), url_filter (10), word_bpe (11),
lexical (12), spelling (13). ``queries`` and ``oracles`` hold the registered queries and their SQL.
"""
