"""Composite datasets (P1-P5) and union views."""
