"""Operators for training-data work on names, records and texts. Nothing outside this package imports it."""
