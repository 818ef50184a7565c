"""Operators on cohort tables."""
