"""Training-data operators for large text corpora (documents, pages, conversations).

Nothing else in the library imports this subpackage.  Each module holds one
operator with its own general interface; ``queries.py`` holds the registered
queries and ``oracle.py`` their SQL where SQL can express them.
"""
