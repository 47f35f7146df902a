"""Summaries, reports, checks and whole jobs built from the operators."""
