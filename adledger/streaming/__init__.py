"""Incremental refresh of the published datasets (see refresh.py)."""
