"""Relational operators over half-open integer intervals, and what builds on them."""
