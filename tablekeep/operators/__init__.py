"""Relational steps, key matching, upserts, table definition and table upkeep."""
