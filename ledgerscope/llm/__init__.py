"""Training-data pipeline operators over documents, pages and embeddings.

Nothing outside this subpackage imports it; ``__spark_entry__.py`` adds its
queries when it is present."""
