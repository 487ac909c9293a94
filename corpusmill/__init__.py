"""Corpus building and redundancy measurement as Spark DataFrame jobs."""
