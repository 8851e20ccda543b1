"""Scalar expressions and SQL functions."""
