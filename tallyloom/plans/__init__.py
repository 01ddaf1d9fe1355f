"""Composed jobs and the registry of checked queries."""
