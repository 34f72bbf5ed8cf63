"""Spark jobs for text corpora, lexical retrieval, small models and run logs."""
