"""Crawl-corpus analytics on Spark DataFrames: extraction, link traversal, word and full-text search."""
