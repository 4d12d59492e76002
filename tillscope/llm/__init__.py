"""Training-data operators: methods over documents, pages and embeddings.

Nothing else in the package imports this subpackage; ``queries.py`` holds
the registered queries and their SQL.
"""
