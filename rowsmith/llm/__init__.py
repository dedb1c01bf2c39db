"""Operators that prepare records and text for model training."""
