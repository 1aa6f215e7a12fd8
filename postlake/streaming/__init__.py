"""Incremental execution of the batch operators."""
