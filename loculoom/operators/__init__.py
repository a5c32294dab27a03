"""Operators on genotype calls, cohorts and reports."""
