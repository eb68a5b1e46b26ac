"""Command line entry points."""
