"""Composed layers, SQL models and the registry of checkable queries."""
