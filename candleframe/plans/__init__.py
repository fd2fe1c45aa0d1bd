"""Composite analyses, the registered query set and its SQL oracle."""
