"""Retrieval analytics on Spark: chunking, embedding, indexing, retrieval and evaluation as DataFrame plans."""
