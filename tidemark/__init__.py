"""Tidemark: bronze / silver / gold transaction analytics on PySpark."""
