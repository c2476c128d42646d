"""Training-data operators (HTML, WARC, tokens, packing, secrets, duplicates, language).

Nothing else in the library imports this package.  Each module holds one
operator with its own general interface; ``queries`` holds the thin registered
queries.  Operators select the columns they need first, so extra columns of
the input (whatever their names) never clash with theirs.
"""
