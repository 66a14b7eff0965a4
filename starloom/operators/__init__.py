"""Warehouse operators: keys, merges, SCD2, dimensions, facts, checks."""
