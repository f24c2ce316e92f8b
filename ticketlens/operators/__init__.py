"""Reusable DataFrame operators: cleaning, checks, star model, ranking, measures, sampling."""
