"""Spark ML on the per-stay matrix and on sequence windows."""
