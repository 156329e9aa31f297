"""Training-data operators on documents, pages and embeddings.

Nothing outside this subpackage imports it; ``__spark_entry__`` adds its
queries when it can be imported.
"""
