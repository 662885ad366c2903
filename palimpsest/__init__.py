"""Palimpsest: a Spark-first engine for restoring and analysing archived web pages."""
