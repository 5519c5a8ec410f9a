"""Keeping stored tables up to date from streams."""
