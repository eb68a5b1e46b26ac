"""Checks on data and on the runs that produced it."""
