"""Assembled jobs and the named query catalog."""
