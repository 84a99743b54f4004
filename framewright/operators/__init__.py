"""Relational operators: selection, coverage, un-nesting, pooling, gating, tracks."""
