"""Operators, one module per family (see README for the inventory)."""
