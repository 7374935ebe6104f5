"""Composed jobs: feature preparation, feature groups, models."""
