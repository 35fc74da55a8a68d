"""Tidemark: disclosure analytics over very large document collections, on Spark."""
