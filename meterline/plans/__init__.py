"""Whole jobs: raw files to silver, silver to gold."""
