"""Delimited files, the dataset registry, stored tables and incremental loading."""
