"""Scans, raw landing and views."""
