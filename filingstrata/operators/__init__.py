"""Reusable DataFrame operators: imputation, surrogate keys, quantiles, profiles, breakdowns."""
