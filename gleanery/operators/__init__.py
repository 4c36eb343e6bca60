"""Operators: ``DataFrame -> DataFrame`` functions."""
