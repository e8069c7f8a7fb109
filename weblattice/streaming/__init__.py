"""Structured Streaming forms of the crawl indexes."""
