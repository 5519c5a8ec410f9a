"""Keyed updates, partition replacement, schema drift, history, sets, checks and user functions."""
