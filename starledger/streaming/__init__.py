"""Landed pages as they arrive."""
