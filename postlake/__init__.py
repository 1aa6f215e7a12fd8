"""Posting analytics on Spark: ingest, merge, normalise, classify, expand, aggregate and report."""
