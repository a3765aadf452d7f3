"""Verified archives: a session's files compressed, stored, read back, and restored."""
