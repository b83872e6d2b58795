"""Training-data operators for text corpora.

Nothing else in the library imports this subpackage.  Each module holds one
operator with its own interface; ``registry`` holds the ``opN_*`` queries that
apply them to the test tables.
"""
